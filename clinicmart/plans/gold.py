"""Star schema: dimensions, facts and the denormalised frame."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicmart.functions import dates, measures, text
from clinicmart.operators import quality
from clinicmart.operators.joins import lookup
from clinicmart.operators.keys import dense_key
from clinicmart.operators.rows import first_per_key
from clinicmart.schema import (
    CALENDAR_COLUMNS,
    CAMPAIGN_FACT_COLUMNS,
    CENTER_COLUMNS,
    CENTER_TEXT,
    FACT_COLUMNS,
    FACT_KEYS,
    OPTIONAL_FACT_KEYS,
    REQUIRED_FACT_KEYS,
    STATE_FLAGS,
    WAIT_COUNT,
    WIDE_COLUMNS,
)


@dataclass(frozen=True)
class Dimensions:
    calendar: DataFrame
    center: DataFrame
    specialty: DataFrame
    channel: DataFrame
    state: DataFrame
    context: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        """Under their stored names, in load order."""
        names = [table for table, _ in FACT_KEYS.values()]
        return dict(zip(names, (getattr(self, f.name) for f in fields(self))))

    @classmethod
    def from_tables(cls, tables: Mapping[str, DataFrame]) -> Dimensions:
        return cls(*[tables[table] for table, _ in FACT_KEYS.values()])


@dataclass(frozen=True)
class Star:
    dims: Dimensions
    fact: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        """Dimensions first, then the fact."""
        return {**self.dims.tables(), "FactAtenciones": self.fact}

    def __iter__(self) -> Iterator[tuple[str, DataFrame]]:
        return iter(self.tables().items())


# ------------------------------------------------------------------ dimensions


def calendar_dimension(tickets: DataFrame, column: str = "fechaHoraReserva") -> DataFrame:
    """One row per day that occurs; the key is the date itself as a number."""
    days = tickets.select(dates.day(F.col(column)).alias("fecha")).dropna().distinct()
    day = F.col("fecha")
    parts = days.withColumns(
        {
            "fecha_key": dates.date_key(day),
            "anio": F.year(day),
            "trimestre": F.quarter(day),
            "mes": F.month(day),
            "dia": F.dayofmonth(day),
            "dia_semana": dates.iso_weekday(day),
        }
    )
    return parts.withColumns(
        {
            "nombre_mes": dates.month_name(F.col("mes")),
            "nombre_dia": dates.day_name(F.col("dia_semana")),
        }
    ).select(*CALENDAR_COLUMNS)


def center_dimension(centers: DataFrame) -> DataFrame:
    """Distinct centres, numbered by department, city and name."""
    clean = centers.withColumns({c: text.normalize_text(F.col(c)) for c in CENTER_TEXT})
    distinct = clean.select(*CENTER_COLUMNS).distinct()
    order = ["departamento", "ciudad", "centroSalud", "area", "capacidadDiaria"]
    return dense_key(distinct, order, "centro_key").select("centro_key", *CENTER_COLUMNS)


def label_dimension(df: DataFrame, label: str, key: str) -> DataFrame:
    """Distinct labels numbered in ascending order; a null label comes last."""
    return label_dimensions(df, {label: key})[label]


def label_dimensions(df: DataFrame, labels: Mapping[str, str]) -> dict[str, DataFrame]:
    """A dimension for each label, from one scan: label -> (key, label).

    The distinct combinations of labels are stacked and numbered together, by label and
    value; a key counts from the first of its label.
    """
    cells = [part for i, label in enumerate(labels) for part in (F.lit(i), F.col(label).cast("string"))]
    combined = df.select(*labels).distinct()
    values = combined.select(F.stack(F.lit(len(labels)), *cells).alias("_label", "_value")).distinct()
    numbered = dense_key(values, ["_label", "_value"], "_n")
    first = numbered.groupBy("_label").agg(F.min("_n").alias("_first"))
    keyed = numbered.join(first, "_label")
    types = {f.name: f.dataType for f in df.schema.fields}
    return {
        label: keyed.filter(F.col("_label") == i).select(
            (F.col("_n") - F.col("_first") + 1).alias(key), F.col("_value").cast(types[label]).alias(label)
        )
        for i, (label, key) in enumerate(labels.items())
    }


# Label of a ticket -> key of its dimension.
TICKET_LABELS = {"especialidad": "especialidad_key", "canalReserva": "canal_key", "estado": "estado_key"}


def specialty_dimension(tickets: DataFrame) -> DataFrame:
    return label_dimension(tickets, "especialidad", TICKET_LABELS["especialidad"])


def channel_dimension(tickets: DataFrame) -> DataFrame:
    return label_dimension(tickets, "canalReserva", TICKET_LABELS["canalReserva"])


def state_dimension(tickets: DataFrame) -> DataFrame:
    return label_dimension(tickets, "estado", TICKET_LABELS["estado"])


def campaign_type_dimension(campaigns: DataFrame) -> DataFrame:
    return label_dimension(campaigns, "tipo", "tipo_campana_key")


def context_dimension(indicator: DataFrame) -> DataFrame:
    """Yearly indicator, numbered by year. Of rows that repeat a year, the first by country and value stays."""
    yearly = first_per_key(indicator, ["anio"], ["pais", "valor_cepal"])
    clean = yearly.withColumn("pais", text.normalize_text(F.col("pais")))
    return dense_key(clean, ["anio"], "contexto_key").select(
        "contexto_key", "anio", "pais", "valor_cepal"
    )


def build_dimensions(
    tickets: DataFrame, centers: DataFrame, indicator: DataFrame
) -> Dimensions:
    labels = label_dimensions(tickets, TICKET_LABELS)
    return Dimensions(
        calendar=calendar_dimension(tickets),
        center=center_dimension(centers),
        specialty=labels["especialidad"],
        channel=labels["canalReserva"],
        state=labels["estado"],
        context=context_dimension(indicator),
    )


# ----------------------------------------------------------------------- facts


def visit_fact(
    tickets: DataFrame,
    dims: Dimensions,
    order_by: Sequence[str] = ("fechaHoraReserva", "codigoFicha"),
) -> DataFrame:
    """One row per ticket with its dimension keys, flags and measures.

    ``tickets`` is a stored table. Rows are numbered in ``order_by`` before descriptions are swapped for
    keys, so that each lookup runs once, on the way to where the fact is written. Numbering
    by reservation time also leaves the rows of a period next to each other,
    so a stored fact is clustered by date without a shuffle of its own.
    """
    numbered = dense_key(ticket_measures(tickets), order_by, "atencion_key", stored=True)
    # Each dimension has one row per value, so the rows stay those of tickets.
    joined = lookup(numbered, dims.calendar.select("fecha_key", "fecha", "anio"), ["fecha", "anio"])
    joined = lookup(joined, dims.center, list(CENTER_COLUMNS))
    joined = lookup(joined, dims.specialty, ["especialidad"])
    joined = lookup(joined, dims.channel, ["canalReserva"])
    joined = lookup(joined, dims.state, ["estado"])
    joined = lookup(joined, dims.context.select("contexto_key", "anio"), ["anio"])
    return joined.select(*FACT_COLUMNS)


def ticket_measures(tickets: DataFrame) -> DataFrame:
    """The ticket columns the fact needs; names of people are left behind here."""
    flags = [
        measures.flag(F.col("estado") == label).alias(name) for name, label in STATE_FLAGS.items()
    ]
    return tickets.select(
        "codigoFicha", "fechaHoraReserva", dates.day(F.col("fechaHoraReserva")).alias("fecha"),
        "anio", *CENTER_COLUMNS, "especialidad", "canalReserva", "estado",
        "tiempoEsperaMin", "edad_aprox", *flags, F.lit(1).alias("conteoFicha"),
    )


def campaign_fact(
    campaigns: DataFrame,
    centers: DataFrame,
    types: DataFrame,
    order_by: Sequence[str] = ("codigoCampana",),
) -> DataFrame:
    """One row per campaign with centre, type and date keys."""
    numbered = dense_key(
        campaigns.select(
            "codigoCampana", "centroSalud", "tipo", "estado", "duracionDias",
            dates.date_key(F.col("fechaInicio")).alias("fecha_inicio_key"),
            dates.date_key(F.col("fechaFin")).alias("fecha_fin_key"),
            F.lit(1).alias("totalCampanas"),
        ),
        order_by,
        "campana_key",
    )
    joined = lookup(numbered, centers.select("centro_key", "centroSalud"), ["centroSalud"])
    joined = lookup(joined, types, ["tipo"])
    return joined.select(*CAMPAIGN_FACT_COLUMNS)


def summarise(star: Star) -> Star:
    """The star with its fact summed up per combination of keys.

    Flags, counts and waits are sums, with the number of waits beside them.
    Slices give the same figures from it as from the fact, so a set of charts
    over one large fact needs a single scan: store the summary and slice that.
    """
    measures_ = ("conteoFicha", *STATE_FLAGS, "tiempoEsperaMin")
    summed = star.fact.groupBy(*FACT_KEYS).agg(
        *[F.sum(c).alias(c) for c in measures_], F.count("tiempoEsperaMin").alias(WAIT_COUNT)
    )
    return Star(star.dims, summed)


# ------------------------------------------------------------- wide and checks


def fact_of_years(star: Star, years: Sequence[int] | None) -> DataFrame:
    """The fact, restricted to years by ranges of its date key.

    A range on a stored column reaches the scan and skips files, which a
    filter on the calendar's year would not.
    """
    if years is None:
        return star.fact
    key = F.col("fecha_key")
    wanted = F.lit(False)
    for year in years:
        wanted = wanted | key.between(year * 10_000, year * 10_000 + 9_999)
    return star.fact.filter(wanted)


def star_wide(
    star: Star, years: Sequence[int] | None = None, extra: Sequence[str] = ()
) -> DataFrame:
    """The fact with its descriptions, base of all slices.

    ``years`` restricts the scan, ``extra`` names further fact columns to keep.
    A summarised fact has a count of waits but no ages.
    """
    fact = fact_of_years(star, years)
    wanted = list(WIDE_COLUMNS)
    if WAIT_COUNT in fact.columns:
        wanted = [c for c in wanted if c != "edad_aprox"] + [WAIT_COUNT]
    dims = star.dims
    return (
        fact.join(dims.calendar.select("fecha_key", "fecha", "anio", "mes", "nombre_mes"), "fecha_key")
        .join(
            dims.center.select(
                "centro_key", "departamento", "ciudad", "centroSalud", "capacidadDiaria"
            ),
            "centro_key",
        )
        .join(dims.specialty, "especialidad_key")
        .join(dims.channel, "canal_key")
        .join(dims.state, "estado_key")
        .join(dims.context.select("contexto_key", "valor_cepal"), "contexto_key", "left")
        .select(*wanted, *extra)
    )


#: What is counted while the fact is written.
FACT_COUNTS = ("claves completas", REQUIRED_FACT_KEYS, None)


def key_rules(star: Star) -> DataFrame:
    """Keys unique, every key found in its dimension. Two scans of the fact, of its keys only."""
    references = {
        column: (star.dims.tables()[table], key) for column, (table, key) in FACT_KEYS.items()
    }
    primary = [
        quality.uniqueness(dim, [key], f"clave {table}")
        for table, (dim, key) in (
            (FACT_KEYS[c][0], references[c]) for c in FACT_KEYS
        )
    ]
    return quality.merge_reports(
        *primary,
        quality.unique_numbers(star.fact, "atencion_key", "clave FactAtenciones"),
        quality.orphans(star.fact, references, OPTIONAL_FACT_KEYS),
    )


def gold_rules(star: Star) -> DataFrame:
    """All checks on a stored star: its keys, and required keys present."""
    rule, columns, _ = FACT_COUNTS
    return quality.merge_reports(key_rules(star), quality.completeness(star.fact, columns, rule))


def campaign_lookup_rules(campaigns: DataFrame, centers: DataFrame, types: DataFrame) -> DataFrame:
    """Whether the names that campaigns refer by stand for one centre and one type each.

    Two centres of one name would repeat each of their campaigns, so this is asked before the lookup.
    """
    return quality.merge_reports(
        quality.fan_out(campaigns, centers, ["centroSalud"], "centro ambiguo"),
        quality.fan_out(campaigns, types, ["tipo"], "tipo ambiguo"),
    )


#: What is counted while the campaign fact is written. A campaign may have no known centre.
CAMPAIGN_FACT_COUNTS = (
    "claves campanas", ["campana_key", "codigoCampana", "tipo_campana_key", "fecha_inicio_key", "fecha_fin_key"], None,
)


def campaign_key_rules(fact: DataFrame, centers: DataFrame, types: DataFrame) -> DataFrame:
    """Campaign keys unique, every centre and type found."""
    references = {"centro_key": (centers, "centro_key"), "tipo_campana_key": (types, "tipo_campana_key")}
    return quality.merge_reports(
        quality.uniqueness(types, ["tipo_campana_key"], "clave DimTipoCampana"),
        quality.unique_numbers(fact, "campana_key", "clave FactCampanas"),
        quality.uniqueness(fact, ["codigoCampana"], "campanas unicas en FactCampanas"),
        quality.orphans(fact, references, ["centro_key"], "referencia campanas"),
    )


def campaign_rules(fact: DataFrame, centers: DataFrame, types: DataFrame) -> DataFrame:
    """All checks on a stored campaign star."""
    rule, columns, _ = CAMPAIGN_FACT_COUNTS
    return quality.merge_reports(
        campaign_key_rules(fact, centers, types), quality.completeness(fact, columns, rule)
    )
