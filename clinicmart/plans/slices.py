"""Results over a slice of the star chosen by year, centre and specialty."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicmart.functions import dates, measures
from clinicmart.operators.rows import is_empty, rename_columns
from clinicmart.plans.gold import Star, fact_of_years, star_wide
from clinicmart.plans.views import attended_waits, daily_saturation
from clinicmart.schema import (
    CLOSED_STATES,
    DETAIL_COLUMNS,
    DRILL_DISPLAY,
    NOSHOW_BANDS,
    OPTIONAL_FACT_KEYS,
    SATURATION_BANDS,
    STATE_FLAGS,
    WAIT_COUNT,
)


@dataclass(frozen=True)
class Selection:
    """Chosen values per column. None takes every known value, () takes nothing."""

    years: Sequence[int] | None = None
    centers: Sequence[str] | None = None
    specialties: Sequence[str] | None = None

    def of_tickets(self) -> Column:
        return (
            _chosen("anio", self.years)
            & _chosen("centroSalud", self.centers)
            & _chosen("especialidad", self.specialties)
        )

    def of_saturation(self) -> Column:
        """Saturation is a matter of centre and day; the specialty does not apply."""
        return _chosen("centroSalud", self.centers) & _chosen("anio", self.years)


def _chosen(column: str, values: Sequence | None) -> Column:
    col = F.col(column)
    return col.isNotNull() if values is None else col.isin(list(values))


def slice_wide(wide: DataFrame, selection: Selection) -> DataFrame:
    return wide.filter(selection.of_tickets())


def slice_star(star: Star, selection: Selection, extra: Sequence[str] = ()) -> DataFrame:
    """Denormalised slice; chosen years also restrict the scan of the fact."""
    return slice_wide(star_wide(star, selection.years, extra), selection)


# Column of a slice -> (key of the fact and of the dimension, dimension).
_SOURCES = {
    **dict.fromkeys(("fecha", "anio", "mes", "nombre_mes"), ("fecha_key", "calendar")),
    **dict.fromkeys(("departamento", "ciudad", "centroSalud", "capacidadDiaria"), ("centro_key", "center")),
    "especialidad": ("especialidad_key", "specialty"),
    "canalReserva": ("canal_key", "channel"),
    "estado": ("estado_key", "state"),
    "valor_cepal": ("contexto_key", "context"),
}


def _matching(star: Star, selection: Selection) -> dict[str, DataFrame]:
    """Fact key -> the keys a selection allows, from the dimensions alone."""
    chosen = {"anio": selection.years, "centroSalud": selection.centers, "especialidad": selection.specialties}
    return {
        _SOURCES[c][0]: getattr(star.dims, _SOURCES[c][1]).filter(_chosen(c, values)).select(_SOURCES[c][0])
        for c, values in chosen.items()
    }


def slice_groups(star: Star, selection: Selection | None, by: Sequence[str]) -> DataFrame:
    """A slice summed up per value of some columns, with the number of waits beside their sum.

    The selection becomes key sets of the dimensions, which drop rows of the fact as it is scanned;
    what is left is summed per key before it meets a dimension, and then only those that
    ``by`` needs. The series, distributions and drill-downs below take such a frame as they take
    a slice; those of attended tickets need ``estado`` among the columns. Every fact key must be in its
    dimension, as the rules of the star have it. No selection takes all rows, unknown values too.
    """
    fact = fact_of_years(star, selection.years if selection else None)
    number = F.col(WAIT_COUNT) if WAIT_COUNT in fact.columns else F.col("tiempoEsperaMin").isNotNull().cast("bigint")
    fact = fact.withColumn(WAIT_COUNT, number)
    for key, allowed in (_matching(star, selection) if selection else {}).items():
        fact = fact.join(allowed, key, "left_semi")
    keys = list(dict.fromkeys(_SOURCES[c][0] for c in by))
    measures_ = ("conteoFicha", *STATE_FLAGS, "tiempoEsperaMin", WAIT_COUNT)
    groups = fact.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in measures_])
    for key in keys:
        columns = [c for c in by if _SOURCES[c][0] == key]
        dimension = getattr(star.dims, _SOURCES[columns[0]][1])
        groups = groups.join(dimension.select(key, *columns), key, "left" if key in OPTIONAL_FACT_KEYS else "inner")
    return groups.groupBy(*by).agg(*[F.sum(c).alias(c) for c in measures_])


def headline(star: Star, selection: Selection) -> DataFrame:
    """``kpi_row`` of a slice and of its saturation, from one scan of the fact.

    Groups by day, centre, specialty and state are described once. Summed per day and centre they give
    the saturation, which the specialty does not touch; summed where the selection holds they
    give the totals.
    """
    fact = fact_of_years(star, selection.years)
    keys = ("fecha_key", "centro_key", "especialidad_key", "estado_key")
    sums = ("conteoFicha", "esAtendida", "esAusente", "esCancelada")
    groups = fact.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], *attended_waits(fact))
    days = ("fecha", "anio", "mes", "nombre_mes", "departamento", "ciudad", "centroSalud", "capacidadDiaria")
    dims = star.dims
    described = (
        groups.join(dims.calendar.select("fecha_key", *days[:4]), "fecha_key")
        .join(dims.center.select("centro_key", *days[4:]), "centro_key")
        .join(dims.specialty, "especialidad_key", "left")
        .join(dims.state.select("estado_key", "estado", F.lit(True).alias("_state")), "estado_key", "left")
    )
    mine = selection.of_tickets() & F.col("_state")
    closed = F.when(F.col("estado").isin(*CLOSED_STATES), F.col("conteoFicha"))
    measured = {**{c: F.col(c) for c in (*sums, "espera", "con_espera")}, "cerradas": closed}
    per_day = described.groupBy(*days).agg(
        F.sum("conteoFicha").alias("total_fichas_dia"),
        *[F.sum(F.when(mine, value)).alias(name) for name, value in measured.items()],
    )
    rate = measures.rate_decimal(F.col("total_fichas_dia"), F.col("capacidadDiaria"))
    counted = selection.of_saturation()
    names = ("total_fichas", "total_atendidas", "total_ausentes", "total_canceladas", "total_cerradas")
    whole = per_day.withColumn("_rate", F.when(counted, rate)).agg(
        *[F.coalesce(_total(c), F.lit(0)).alias(n) for c, n in zip((*sums, "cerradas"), names)],
        (F.sum("espera") / F.nullif(F.sum("con_espera"), F.lit(0))).alias("espera"),
        F.count_if(counted).alias("dias"),
        _mean_cents("_rate").alias("indice"),
    )
    index = F.when(F.col("dias") == 0, F.lit(0.0)).otherwise(measures.round_half_even(F.col("indice"), 1))
    return _headline(whole).withColumn("indice_saturacion", index).drop("dias", "indice")


def _headline(totals: DataFrame) -> DataFrame:
    """Rates and the rounded mean wait beside the totals. Rates of nothing are 0."""
    no_show = measures.rate_number(F.col("total_ausentes"), F.col("total_cerradas"), 2)
    attended = measures.rate_number(F.col("total_atendidas"), F.col("total_fichas"), 1)
    return totals.withColumns(
        {
            "tasa_ausentismo": F.coalesce(no_show, F.lit(0.0)),
            "espera_promedio": measures.round_half_even(F.col("espera"), 1),
            "tasa_atencion": F.coalesce(attended, F.lit(0.0)),
        }
    ).drop("espera")


def slice_saturation(saturation: DataFrame, selection: Selection) -> DataFrame:
    return saturation.filter(selection.of_saturation())


def star_saturation(star: Star, selection: Selection) -> DataFrame:
    """Daily saturation of a slice; chosen years also restrict the scan of the fact."""
    return slice_saturation(daily_saturation(star, selection.years), selection)


def no_rows(sliced: DataFrame) -> bool:
    """Whether a slice is empty, to be asked before showing anything of it."""
    return is_empty(sliced)


def filter_options(wide: DataFrame) -> DataFrame:
    """Values on offer per filter: ``(filtro, valor)``, from one scan."""
    known = wide.select("anio", "centroSalud", "especialidad").distinct()
    long = known.selectExpr(
        "stack(3, 'anio', cast(anio as string), 'centroSalud', centroSalud, "
        "'especialidad', especialidad) as (filtro, valor)"
    )
    return long.filter(F.col("valor").isNotNull()).distinct().orderBy("filtro", "valor")


# -------------------------------------------------------------------- measures


def _total(column: str) -> Column:
    return F.sum(column)


def _counts(fichas: str, attended: str, absent: str, cancelled: str) -> list[Column]:
    return [
        _total("conteoFicha").alias(fichas),
        _total("esAtendida").alias(attended),
        _total("esAusente").alias(absent),
        _total("esCancelada").alias(cancelled),
    ]


def _attended() -> Column:
    """Attended ticket, or group of attended tickets in a summarised fact."""
    return F.col("esAtendida") > 0


def _mean_wait(df: DataFrame, test: Column | None = None) -> Column:
    """Mean of the known waits, from tickets or from summarised tickets."""
    wait = F.col("tiempoEsperaMin").cast("double")
    number = F.col(WAIT_COUNT) if WAIT_COUNT in df.columns else wait.isNotNull().cast("bigint")
    if test is not None:
        wait, number = F.when(test, wait), F.when(test, number)
    return F.sum(wait) / F.nullif(F.sum(number), F.lit(0))


def _mean_cents(column: str) -> Column:
    """Mean of two-decimal values; the sum is exact, so the order of rows is no matter."""
    return F.sum(column).cast("double") / F.nullif(F.count(column), F.lit(0))


def kpi_row(sliced: DataFrame, saturation: DataFrame) -> DataFrame:
    """Headline figures of a slice; ``saturation`` is the matching saturation slice.

    Rates of nothing are 0; the mean wait of nothing is null.
    """
    index = saturation.agg(
        F.when(F.count("*") == 0, F.lit(0.0))
        .otherwise(measures.round_half_even(_mean_cents("indice_saturacion_pct"), 1))
        .alias("indice")
    )
    closed = F.when(F.col("estado").isin(*CLOSED_STATES), F.col("conteoFicha"))
    totals = sliced.agg(
        *[
            F.coalesce(_total(c), F.lit(0)).alias(name)
            for c, name in (
                ("conteoFicha", "total_fichas"),
                ("esAtendida", "total_atendidas"),
                ("esAusente", "total_ausentes"),
                ("esCancelada", "total_canceladas"),
            )
        ],
        F.coalesce(F.sum(closed), F.lit(0)).alias("total_cerradas"),
        _mean_wait(sliced, _attended()).alias("espera"),
    )
    return _headline(totals).withColumn("indice_saturacion", index.scalar())


def kpi_bands(kpis: DataFrame) -> DataFrame:
    """The two headline rates with their three-level labels."""
    return kpis.select(
        "tasa_ausentismo",
        measures.band(F.col("tasa_ausentismo"), NOSHOW_BANDS).alias("nivel_ausentismo"),
        "indice_saturacion",
        measures.band(F.col("indice_saturacion"), SATURATION_BANDS).alias("nivel_saturacion"),
    )


# ------------------------------------------------------- series, distributions


def _grouped(sliced: DataFrame, *columns: str):
    """Groups over known values only."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return sliced.filter(known).groupBy(*columns)


def monthly(sliced: DataFrame) -> DataFrame:
    """Totals per month with a sortable period label."""
    series = _grouped(sliced, "anio", "mes").agg(
        *_counts("total_fichas", "total_atendidas", "total_ausentes", "total_canceladas")
    )
    return series.withColumn("periodo", dates.period(F.col("anio"), F.col("mes"))).orderBy(
        "periodo"
    )


def distribution(sliced: DataFrame, label: str) -> DataFrame:
    """Tickets per label, largest first, with their share of the slice in percent."""
    totals = _grouped(sliced, label).agg(_total("conteoFicha").alias("total"))
    # The grand total is one value over the few labels that are left.
    grand = totals.agg(F.sum("total").alias("g"))
    share = measures.rate_float(F.col("total"), grand.scalar(), 1)
    return totals.withColumn("porcentaje", share).orderBy(F.desc("total"), label)


def state_distribution(sliced: DataFrame) -> DataFrame:
    return distribution(sliced, "estado")


def channel_distribution(sliced: DataFrame) -> DataFrame:
    return distribution(sliced, "canalReserva").drop("porcentaje")


def noshow(sliced: DataFrame) -> DataFrame:
    """No-shows as a share of all tickets, per specialty, lowest first."""
    totals = _grouped(sliced, "especialidad").agg(
        _total("conteoFicha").alias("total_fichas"), _total("esAusente").alias("total_ausentes")
    )
    rate = measures.rate_float(F.col("total_ausentes"), F.col("total_fichas"), 2)
    return totals.withColumn("tasa_ausentismo_pct", rate).orderBy(
        "tasa_ausentismo_pct", "especialidad"
    )


# ------------------------------------------------------------------ drill-down


def _drill(sliced: DataFrame, fixed: str, value: str, by: str) -> DataFrame:
    chosen = sliced.filter(F.col(fixed) == F.lit(value))
    totals = _grouped(chosen, by).agg(
        *_counts("total_fichas", "atendidas", "ausentes", "canceladas"),
        measures.round_half_even(_mean_wait(sliced), 1).alias("espera_prom"),
    )
    return totals.withColumns(
        {
            "tasa_atencion": measures.rate_float(F.col("atendidas"), F.col("total_fichas"), 1),
            "tasa_ausentismo": measures.rate_float(F.col("ausentes"), F.col("total_fichas"), 1),
        }
    ).select(
        by, "total_fichas", "atendidas", "ausentes", "canceladas", "tasa_atencion",
        "tasa_ausentismo", "espera_prom",
    )


def drill_specialty(sliced: DataFrame, specialty: str, descending: bool = True) -> DataFrame:
    """Centres of one specialty by no-show rate; mean wait over all tickets that have one.

    The table shows the highest rate first, the chart the lowest.
    """
    rate = F.col("tasa_ausentismo")
    return _drill(sliced, "especialidad", specialty, "centroSalud").orderBy(
        rate.desc() if descending else rate.asc(), "centroSalud"
    )


def drill_center(sliced: DataFrame, center: str) -> DataFrame:
    """Specialties of one centre, most tickets first."""
    return _drill(sliced, "centroSalud", center, "especialidad").orderBy(
        F.desc("total_fichas"), "especialidad"
    )


def display(drilled: DataFrame) -> DataFrame:
    """A drill-down under the headings it is shown with."""
    return rename_columns(drilled, DRILL_DISPLAY)


def saturation_by_center(saturation: DataFrame) -> DataFrame:
    """Mean of the daily saturation per centre, lowest first."""
    means = _grouped(saturation, "centroSalud").agg(
        _mean_cents("indice_saturacion_pct").alias("media")
    )
    rounded = measures.round_half_even(F.col("media"), 1).alias("indice_saturacion_pct")
    return means.orderBy(F.asc_nulls_last("media"), "centroSalud").select("centroSalud", rounded)


def wait_by_specialty(sliced: DataFrame) -> DataFrame:
    """Mean wait of attended tickets per specialty, longest first."""
    attended = sliced.filter(_attended())
    means = _grouped(attended, "especialidad").agg(
        measures.round_half_even(_mean_wait(sliced), 1).alias("espera_promedio")
    )
    return means.orderBy(F.desc_nulls_last("espera_promedio"), "especialidad")


def demand_and_context(sliced: DataFrame) -> DataFrame:
    """Tickets and outside indicator per year."""
    return (
        _grouped(sliced, "anio")
        .agg(
            _total("conteoFicha").alias("total_fichas"),
            F.max("valor_cepal").alias("valor_cepal"),
        )
        .orderBy("anio")
    )


# ---------------------------------------------------------------------- detail


def detail_header(sliced: DataFrame) -> DataFrame:
    """Rows, distinct centres and specialties, first and last year.

    Counting distinct values straight away would copy every row once per
    column; grouping first leaves only the combinations to be counted.
    """
    combinations = sliced.groupBy("anio", "centroSalud", "especialidad").agg(
        _total("conteoFicha").alias("n")
    )
    return combinations.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_registros"),
        F.countDistinct("centroSalud").alias("centros_activos"),
        F.countDistinct("especialidad").alias("especialidades"),
        F.min("anio").alias("anio_min"),
        F.max("anio").alias("anio_max"),
    )


def detail_rows(sliced: DataFrame) -> DataFrame:
    """The records of a slice, newest first.

    The further sort columns make the order repeatable and let the range
    shuffle split a day that holds a large part of the rows.
    """
    rest = [c for c in DETAIL_COLUMNS if c != "fecha"]
    unique = [c for c in ("atencion_key",) if c in sliced.columns]
    ordered = sliced.orderBy(F.desc_nulls_last("fecha"), *(unique or rest))
    return ordered.select(*DETAIL_COLUMNS)
