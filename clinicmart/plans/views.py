"""The four analytical views.

Each view shrinks the fact to its keys before it meets a dimension, so the
fact is scanned once, with the few columns the view needs, and the joins work
on groups instead of rows. A star with a summarised fact gives the same views.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicmart.functions import measures
from clinicmart.plans.gold import Star, fact_of_years
from clinicmart.schema import CLOSED_STATES, WAIT_COUNT

# Fact measure -> name of its total.
_TOTALS = {
    "conteoFicha": "total_fichas",
    "esAtendida": "total_atendidas",
    "esAusente": "total_ausentes",
    "esCancelada": "total_canceladas",
    "esReservada": "total_reservadas",
}


def attended_waits(fact: DataFrame) -> list[Column]:
    """Sum and count of the waits of attended tickets, to be averaged later.

    In a summarised fact the waits are sums already, with their number beside them. Its rows
    are of one state, so that either all of their tickets are attended or none.
    """
    wait = F.col("tiempoEsperaMin").cast("double")
    number = F.col(WAIT_COUNT) if WAIT_COUNT in fact.columns else wait.isNotNull().cast("bigint")
    attended = F.col("esAtendida") > 0
    return [
        F.sum(F.when(attended, wait)).alias("espera"),
        F.coalesce(F.sum(F.when(attended, number)), F.lit(0)).alias("con_espera"),
    ]


def general_kpis(star: Star) -> DataFrame:
    """One row: no-show rate of closed tickets, mean wait, mean saturation, totals.

    The mean saturation is over days and centres, unrounded. Totals and
    saturation come from one scan: groups by day, centre and state, then by
    day and centre, then all.
    """
    groups = star.fact.groupBy("fecha_key", "centro_key", "estado_key").agg(
        F.sum("conteoFicha").alias("n"),
        *[F.sum(c).alias(c) for c in _TOTALS],
        *attended_waits(star.fact),
    )
    described = groups.join(
        star.dims.state.select("estado_key", "estado", F.lit(True).alias("_state")),
        "estado_key",
        "left",
    ).join(
        star.dims.center.select("centro_key", "capacidadDiaria", F.lit(True).alias("_center")),
        "centro_key",
        "left",
    )
    # Totals need a known state, saturation a known centre.
    known = F.col("_state")
    days = described.groupBy("fecha_key", "centro_key").agg(
        F.sum(F.when(F.col("_center"), F.col("n"))).alias("n"),
        F.max("capacidadDiaria").alias("capacidad"),
        F.sum(F.when(known & F.col("estado").isin(*CLOSED_STATES), F.col("n"))).alias("cerradas"),
        *[F.sum(F.when(known, F.col(c))).alias(c) for c in (*_TOTALS, "espera", "con_espera")],
    )
    index = F.lit(Decimal("100.0")) * F.col("n") / F.nullif(F.col("capacidad"), F.lit(0))
    return days.agg(
        measures.rate_decimal(F.sum("esAusente"), F.sum("cerradas")).alias("tasa_ausentismo_pct"),
        measures.mean_decimal(F.sum("espera"), F.sum("con_espera")).alias(
            "tiempo_promedio_espera_min"
        ),
        F.avg(index).cast("decimal(10,2)").alias("indice_saturacion_promedio_pct"),
        *[F.sum(c).alias(name) for c, name in _TOTALS.items()],
    )


def daily_saturation(star: Star, years: Sequence[int] | None = None) -> DataFrame:
    """Tickets per day and centre against the centre's daily capacity.

    ``years`` restricts the scan of the fact.
    """
    groups = (
        fact_of_years(star, years)
        .groupBy("fecha_key", "centro_key")
        .agg(F.sum("conteoFicha").alias("n"))
    )
    described = groups.join(
        star.dims.calendar.select("fecha_key", "fecha", "anio", "mes", "nombre_mes"), "fecha_key"
    ).join(
        star.dims.center.select(
            "centro_key", "departamento", "ciudad", "centroSalud", "capacidadDiaria"
        ),
        "centro_key",
    )
    days = described.groupBy(
        "fecha", "anio", "mes", "nombre_mes", "departamento", "ciudad", "centroSalud",
        "capacidadDiaria",
    ).agg(F.sum("n").alias("total_fichas_dia"))
    rate = measures.rate_decimal(F.col("total_fichas_dia"), F.col("capacidadDiaria"))
    return days.withColumn("indice_saturacion_pct", rate)


def noshow_by_specialty(star: Star) -> DataFrame:
    """No-shows as a share of all tickets, per specialty."""
    groups = star.fact.groupBy("especialidad_key").agg(
        F.sum("conteoFicha").alias("fichas"), F.sum("esAusente").alias("ausentes")
    )
    named = groups.join(star.dims.specialty, "especialidad_key")
    totals = named.groupBy("especialidad").agg(
        F.sum("fichas").alias("total_fichas"), F.sum("ausentes").alias("total_ausentes")
    )
    rate = measures.rate_decimal(F.col("total_ausentes"), F.col("total_fichas"))
    return totals.withColumn("tasa_ausentismo_pct", rate)


def monthly_series(star: Star) -> DataFrame:
    """Totals, mean wait of attended tickets and yearly context, per month."""
    groups = star.fact.groupBy("fecha_key", "contexto_key").agg(
        F.sum("conteoFicha").alias("n"),
        *[F.sum(c).alias(c) for c in ("esAtendida", "esAusente", "esCancelada")],
        *attended_waits(star.fact),
    )
    described = groups.join(
        star.dims.calendar.select("fecha_key", "anio", "mes", "nombre_mes"), "fecha_key"
    ).join(star.dims.context.select("contexto_key", "valor_cepal"), "contexto_key", "left")
    return described.groupBy("anio", "mes", "nombre_mes").agg(
        F.sum("n").alias("total_fichas"),
        F.sum("esAtendida").alias("total_atendidas"),
        F.sum("esAusente").alias("total_ausentes"),
        F.sum("esCancelada").alias("total_canceladas"),
        measures.mean_decimal(F.sum("espera"), F.sum("con_espera")).alias("espera_promedio_min"),
        F.max("valor_cepal").alias("valor_cepal"),
    )


VIEWS: dict[str, Callable[[Star], DataFrame]] = {
    "vw_kpis_generales": general_kpis,
    "vw_saturacion_diaria": daily_saturation,
    "vw_ausentismo_especialidad": noshow_by_specialty,
    "vw_serie_mensual": monthly_series,
}


def register_views(star: Star) -> None:
    """Make the star and its views available to SQL, replacing older ones."""
    for name, df in star:
        df.createOrReplaceTempView(name)
    for name, build in VIEWS.items():
        build(star).createOrReplaceTempView(name)
