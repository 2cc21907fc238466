"""Registered queries: name -> function of (spark, folder)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, TimestampNTZType

from clinicmart.functions import dates, measures, parse, text
from clinicmart.operators import keys, quality, rows
from clinicmart.plans import extract, gold, runs, silver, slices, views
from clinicmart.schema import TICKET_RULES
from clinicmart.sources import feed, landing
from clinicmart.sources.store import TierStore
from registry import bindings as b
from registry import marts

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

SOME = slices.Selection(years=(1996, 1997, 1999), specialties=("BUILDING", "MACHINERY"))
DRILL_SPECIALTY = "BUILDING"
DRILL_CENTER = "NATION_7"
_DRILL = ["especialidad", "centroSalud"]


def portable(df: DataFrame) -> DataFrame:
    """Column types that mean the same to every engine the results are compared with."""

    def cast(name: str, dtype) -> Column:
        col = F.col(f"`{name}`")
        if isinstance(dtype, IntegerType):
            return col.cast("bigint").alias(name)
        if isinstance(dtype, DecimalType):
            return col.cast("double").alias(name)
        if isinstance(dtype, (DateType, TimestampNTZType)):
            return col.cast("string").alias(name)
        return col

    return df.select(*[cast(f.name, f.dataType) for f in df.schema.fields])


def register(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(function(spark, sf_dir))

    run.__name__ = function.__name__
    run.__doc__ = function.__doc__
    _QUERIES[function.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ------------------------------------------------------------- scalar cleaning


@register
def clean_text(spark, sf_dir):
    """Strip all white space and upper-case."""
    customer = b.table(spark, sf_dir, "customer")
    return customer.select(
        "c_custkey", text.normalize_text(b.untidy(F.col("c_mktsegment"))).alias("segmento")
    )


@register
def replace_map(spark, sf_dir):
    """Whole-value replacement."""
    names = {"FURNITURE": "MUEBLES", "MACHINERY": "MAQUINARIA"}
    customer = b.table(spark, sf_dir, "customer")
    return customer.select(
        "c_custkey", text.replace_values(F.col("c_mktsegment"), names).alias("segmento")
    )


@register
def fill_default(spark, sf_dir):
    """Addresses cleaned, missing ones filled."""
    campaigns = b.campaign_sources(spark, sf_dir)["CampanaMedica"]
    url = text.fill_default(text.clean_url(F.col("imagenUrl")))
    return campaigns.select("codigoCampana", "l_partkey", url.alias("imagenUrl"))


@register
def decode_year(spark, sf_dir):
    """Plain years stay, codes are shifted, other text is null."""
    events = b.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    code = (
        F.when(k < 50, (k + 29_170).cast("string"))
        .when(k < 90, (k + 1_950).cast("string"))
        .otherwise(F.concat(k.cast("string"), F.lit(".5")))
    )
    coded = events.select("event_id", code.alias("codigo"))
    year = parse.decode_year(F.col("codigo"), coded.schema["codigo"].dataType)
    return coded.select("event_id", year.alias("anio"))


@register
def lenient_cast(spark, sf_dir):
    """Unreadable times and numbers become null."""
    events = b.table(spark, sf_dir, "events")
    bad = F.col("event_id") % 7 == 0
    raw = events.select(
        "event_id",
        F.when(bad, F.lit("mañana")).otherwise(F.col("ts").cast("string")).alias("momento"),
        F.when(F.col("event_id") % 5 == 0, F.lit("n.d."))
        .otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
        .alias("valor"),
    )
    return raw.select(
        "event_id",
        F.date_trunc("HOUR", parse.lenient_timestamp(F.col("momento")))
        .cast("timestamp_ntz")
        .alias("hora"),
        parse.lenient_number(F.col("valor"), raw.schema["valor"].dataType).alias("valor"),
    )


@register
def date_parts(spark, sf_dir):
    """Parts, key, weekday, names and period of a date."""
    day = F.col("o_orderdate")
    return b.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.day(day).alias("fecha"),
        dates.date_key(day).alias("fecha_key"),
        F.year(day).alias("anio"),
        F.quarter(day).alias("trimestre"),
        F.month(day).alias("mes"),
        dates.month_name(F.month(day)).alias("nombre_mes"),
        F.dayofmonth(day).alias("dia"),
        dates.iso_weekday(day).alias("dia_semana"),
        dates.day_name(dates.iso_weekday(day)).alias("nombre_dia"),
        dates.period(F.year(day), F.month(day)).alias("periodo"),
    )


@register
def age_years(spark, sf_dir):
    """C14: whole years at a stated day, 0 where the birth date is missing."""
    patients = b.ticket_sources(spark, sf_dir)["Paciente"]
    age = dates.age_years(F.col("fechaNacimiento"), b.as_of())
    return patients.select("idPaciente", age.alias("edad_aprox"))


@register
def duration_days(spark, sf_dir):
    """Days between two times, rounded down, also when negative."""
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = b.table(spark, sf_dir, "lineitem")
    start = F.col("o_orderdate") + F.expr("INTERVAL '6' HOUR")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        *["l_orderkey", "l_linenumber", "l_partkey"],
        dates.whole_days(start, F.col("l_shipdate")).alias("duracionDias"),
    )


@register
def state_flags(spark, sf_dir):
    """One 0/1 column per state and a constant count."""
    fact = gold.ticket_measures(marts.tickets(spark, sf_dir))
    return fact.select(
        "codigoFicha", "esAtendida", "esAusente", "esCancelada", "esReservada", "conteoFicha"
    )


@register
def flatten_json(spark, sf_dir):
    """IO6: nested JSON text to one column per leaf."""
    events = b.table(spark, sf_dir, "events")
    nested = events.select(
        "event_id",
        F.concat(
            F.lit('{"a": '), F.col("props"), F.lit(', "tipo": "'), F.col("event_type"), F.lit('"}')
        ).alias("doc"),
    )
    flat = feed.parse_records(nested, "doc", "a struct<k: bigint>, tipo string", "doc")
    return flat.withColumnsRenamed({"doc.a.k": "doc_a_k", "doc.tipo": "doc_tipo"})


# ----------------------------------------------------------- rows, keys, files


@register
def dedup_first(spark, sf_dir):
    """First row per key in a stated order."""
    lines = b.table(spark, sf_dir, "lineitem")
    return rows.first_per_key(
        lines, ["l_orderkey", "l_linenumber"],
        ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"],
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@register
def drop_null_required(spark, sf_dir):
    """rows with a null in a required column go."""
    tickets = b.bronze_tickets(spark, sf_dir)
    return rows.require(tickets, ["fechaHoraAtencion", "fechaNacimiento"]).select(
        "codigoFicha", "fechaHoraAtencion", "fechaNacimiento"
    )


@register
def dense_key_ranges(spark, sf_dir):
    """K2: keys 1..n over the whole table, numbered range by range."""
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    total = orders.count()
    return keys.dense_key(
        orders, ["o_orderdate", "o_orderkey"], "clave", rows_per_range=max(1, total // 16)
    )


@register
def csv_roundtrip(spark, sf_dir):
    """IO4, IO7: written as CSV and read back, text untouched, missing values null."""
    path = f"{marts.store(spark, sf_dir).root}/csv/{uuid4().hex}"
    tickets = b.bronze_tickets(spark, sf_dir)
    landing.write_csv(
        tickets.select(
            "codigoFicha", "estado", "fechaHoraReserva", "tiempoEsperaMin", "indicaciones"
        ),
        path,
    )
    back = landing.read_csv(spark, path)
    return back.select(
        "codigoFicha", "estado",
        parse.lenient_timestamp(F.col("fechaHoraReserva")).alias("fechaHoraReserva"),
        parse.lenient_number(
            F.col("tiempoEsperaMin"), back.schema["tiempoEsperaMin"].dataType
        ).alias("tiempoEsperaMin"),
        "indicaciones",
    )


@register
def top_rows(spark, sf_dir):
    """S3: first rows of a view, in a stated order."""
    saturation = views.daily_saturation(marts.star(spark, sf_dir))
    return rows.preview(saturation, 5, [F.desc("total_fichas_dia"), "fecha", "centroSalud"])


@register
def feed_indicator(spark, sf_dir):
    """IO5, B3: records landed as one nested document, read back and cleaned."""
    path = f"{marts.store(spark, sf_dir).root}/feed/{uuid4().hex}"
    # One record per year and flag: a feed is small, however large the table behind it.
    record = F.struct("orden", "dim_29117", "value", "iso3")
    listed = b.repeated_records(spark, sf_dir).agg(F.sort_array(F.collect_list(record)).alias("data"))
    listed.select(F.to_json(F.struct(F.struct("data").alias("body"))).alias("value")).write.text(path)
    records = feed.read_feed(spark, path)
    return silver.clean_indicator(records, [landing.INGEST_ORDER])


# -------------------------------------------------------------------- extracts


@register
def extract_tickets(spark, sf_dir):
    """IO1, J1: eight tables to one wide ticket row."""
    return extract.extract_tickets(b.ticket_sources(spark, sf_dir))


@register
def extract_campaigns(spark, sf_dir):
    """IO2, J2: campaigns with their centre."""
    return extract.extract_campaigns(b.campaign_sources(spark, sf_dir))


@register
def extract_centers(spark, sf_dir):
    """IO3, J3: centres with place and capacity."""
    return extract.extract_centers(b.centers(spark, sf_dir))


# ------------------------------------------------------------------ clean tier


@register
def silver_tickets(spark, sf_dir):
    """B1 on tickets without repeats."""
    return marts.clean_tickets(spark, sf_dir)


@register
def silver_tickets_repeated(spark, sf_dir):
    """B1 on repeated tickets: an incomplete first row removes the ticket."""
    clean = silver.clean_tickets(b.repeated_tickets(spark, sf_dir), b.as_of(), b.LINE_ORDER)
    return clean.drop(*[c for c in b.LINE_ORDER if c != "l_partkey"])


@register
def silver_campaigns(spark, sf_dir):
    """B2 on repeated campaigns."""
    return marts.clean_campaigns(spark, sf_dir).drop(*b.LINE_ORDER)


@register
def silver_indicator(spark, sf_dir):
    """Gaps and other countries go before the first record of a year is chosen."""
    return silver.clean_indicator(b.repeated_records(spark, sf_dir), ["orden"])


# ------------------------------------------------------------------------ star


@register
def dim_calendar(spark, sf_dir):
    """B4."""
    return gold.calendar_dimension(marts.tickets(spark, sf_dir))


@register
def dim_center(spark, sf_dir):
    """B5."""
    return gold.center_dimension(extract.extract_centers(b.centers(spark, sf_dir)))


@register
def dim_specialty(spark, sf_dir):
    """B6."""
    return gold.specialty_dimension(marts.tickets(spark, sf_dir))


@register
def dim_channel(spark, sf_dir):
    """B6."""
    return gold.channel_dimension(marts.tickets(spark, sf_dir))


@register
def dim_state(spark, sf_dir):
    """B6."""
    return gold.state_dimension(marts.tickets(spark, sf_dir))


@register
def dim_context(spark, sf_dir):
    """B7."""
    return gold.context_dimension(marts.indicator(spark, sf_dir))


@register
def campaign_types(spark, sf_dir):
    """B9."""
    return gold.campaign_type_dimension(marts.campaigns(spark, sf_dir))


@register
def fact_visits(spark, sf_dir):
    """The visit fact, built from the stored clean tickets and dimensions."""
    return gold.visit_fact(marts.tickets(spark, sf_dir), marts.star(spark, sf_dir).dims)


@register
def campaign_fact(spark, sf_dir):
    """The campaign fact, built from stored campaigns, centres and types."""
    centers = marts.star(spark, sf_dir).dims.center
    types = marts.campaign_types(spark, sf_dir)
    return gold.campaign_fact(marts.campaigns(spark, sf_dir), centers, types)


@register
def star_wide(spark, sf_dir):
    """The fact with its descriptions."""
    return gold.star_wide(marts.star(spark, sf_dir))


# ----------------------------------------------------------------------- views


@register
def kpis_general(spark, sf_dir):
    """A1."""
    return views.general_kpis(marts.star(spark, sf_dir))


@register
def saturation_daily(spark, sf_dir):
    """A2, A3."""
    return views.daily_saturation(marts.star(spark, sf_dir))


@register
def noshow_specialty(spark, sf_dir):
    """A4."""
    return views.noshow_by_specialty(marts.star(spark, sf_dir))


@register
def monthly_series(spark, sf_dir):
    """A5."""
    return views.monthly_series(marts.star(spark, sf_dir))


@register
def views_by_sql(spark, sf_dir):
    """IO9, IO11: registered views answer SQL."""
    views.register_views(marts.star(spark, sf_dir))
    return spark.sql(
        "SELECT s.anio, s.centroSalud, m.nombre_mes, sum(s.total_fichas_dia) AS fichas, "
        "max(m.total_fichas) AS fichas_mes "
        "FROM vw_saturacion_diaria s JOIN vw_serie_mensual m ON s.anio = m.anio AND s.mes = m.mes "
        "GROUP BY s.anio, s.centroSalud, m.nombre_mes"
    )


# ---------------------------------------------------------------------- slices


def _slice(spark, sf_dir, selection=slices.Selection()):
    return slices.slice_star(marts.star(spark, sf_dir), selection)


def _groups(spark, sf_dir, by, selection=slices.Selection()):
    """A slice summed up per value of some columns."""
    return slices.slice_groups(marts.star(spark, sf_dir), selection, by)


def _saturation(spark, sf_dir, selection=slices.Selection()):
    return slices.star_saturation(marts.star(spark, sf_dir), selection)


@register
def slice_filter(spark, sf_dir):
    """chosen years, centres and specialties."""
    chosen = slices.Selection(SOME.years, ("NATION_1", "NATION_4", "NATION_7"), SOME.specialties)
    return _slice(spark, sf_dir, chosen)


@register
def filter_options(spark, sf_dir):
    """Values on offer per filter."""
    return slices.filter_options(_groups(spark, sf_dir, ["anio", "centroSalud", "especialidad"], None))


@register
def kpi_row(spark, sf_dir):
    """A6 over everything."""
    return slices.headline(marts.star(spark, sf_dir), slices.Selection())


@register
def kpi_row_chosen(spark, sf_dir):
    """A6, F7 over a choice; saturation does not follow the specialty."""
    return slices.headline(marts.star(spark, sf_dir), SOME)


@register
def kpi_bands(spark, sf_dir):
    """C20 on the headline row."""
    return slices.kpi_bands(slices.headline(marts.star(spark, sf_dir), slices.Selection()))


@register
def kpi_row_summary(spark, sf_dir):
    """A6 over a choice, from the stored summary of the fact."""
    return slices.headline(marts.summary(spark, sf_dir), SOME)


@register
def kpis_general_summary(spark, sf_dir):
    """A1 from the stored summary of the fact."""
    return views.general_kpis(marts.summary(spark, sf_dir))


@register
def monthly_series_summary(spark, sf_dir):
    """A5 from the stored summary of the fact."""
    return views.monthly_series(marts.summary(spark, sf_dir))


@register
def drill_center_summary(spark, sf_dir):
    """A12 from the stored summary of the fact."""
    star = marts.summary(spark, sf_dir)
    return slices.drill_center(slices.slice_star(star, slices.Selection()), DRILL_CENTER)


@register
def slice_monthly(spark, sf_dir):
    """A7."""
    return slices.monthly(_groups(spark, sf_dir, ["anio", "mes"], SOME))


@register
def dist_state(spark, sf_dir):
    """A8."""
    return slices.state_distribution(_groups(spark, sf_dir, ["estado"]))


@register
def dist_channel(spark, sf_dir):
    """A9."""
    return slices.channel_distribution(_groups(spark, sf_dir, ["canalReserva"]))


@register
def slice_noshow(spark, sf_dir):
    """A10."""
    return slices.noshow(_groups(spark, sf_dir, ["especialidad"]))


@register
def drill_specialty(spark, sf_dir):
    """Centres within one specialty."""
    return slices.drill_specialty(_groups(spark, sf_dir, _DRILL), DRILL_SPECIALTY)


@register
def drill_center(spark, sf_dir):
    """Specialties within one centre."""
    return slices.drill_center(_groups(spark, sf_dir, _DRILL), DRILL_CENTER)


@register
def drill_display(spark, sf_dir):
    """A drill-down under its display headings."""
    return slices.display(slices.drill_center(_groups(spark, sf_dir, _DRILL), DRILL_CENTER))


@register
def saturation_center(spark, sf_dir):
    """A13."""
    return slices.saturation_by_center(_saturation(spark, sf_dir))


@register
def wait_specialty(spark, sf_dir):
    """A14, F4."""
    return slices.wait_by_specialty(_groups(spark, sf_dir, ["especialidad", "estado"]))


@register
def demand_context(spark, sf_dir):
    """A15."""
    return slices.demand_and_context(_groups(spark, sf_dir, ["anio", "valor_cepal"]))


@register
def detail_header(spark, sf_dir):
    """A16."""
    return slices.detail_header(_groups(spark, sf_dir, ["anio", "centroSalud", "especialidad"], SOME))


@register
def detail_rows(spark, sf_dir):
    """A17."""
    sliced = slices.slice_star(marts.star(spark, sf_dir), slices.Selection(), ("atencion_key",))
    return slices.detail_rows(sliced)


# --------------------------------------------------------------------- quality


@register
def profile_nulls(spark, sf_dir):
    """Q1: rows and nulls per column of the clean tickets."""
    return quality.null_profile(marts.tickets(spark, sf_dir), "fichas")


@register
def summary_document(spark, sf_dir):
    """IO10: rows and nulls per column as a nested document."""
    summary = quality.null_summary({"fichas": marts.tickets(spark, sf_dir)})
    return summary.select("filas_fichas", F.to_json("nulos_fichas").alias("nulos_fichas"))


@register
def check_unique(spark, sf_dir):
    """Q2: rows beyond the first of a key."""
    lines = b.table(spark, sf_dir, "lineitem")
    return quality.uniqueness(lines, ["l_orderkey", "l_linenumber"], "lineas unicas")


@register
def check_not_null(spark, sf_dir):
    """Q3: nulls in required columns."""
    tickets = b.repeated_tickets(spark, sf_dir)
    columns = ["codigoFicha", "estado", "fechaNacimiento", "zona", "tiempoEsperaMin"]
    return quality.completeness(tickets, columns, "fichas completas")


@register
def check_range(spark, sf_dir):
    """Q4: durations below 0 or missing."""
    spans = all_queries()["duration_days"](spark, sf_dir)
    late = F.when(F.col("l_partkey") % 10 != 0, F.col("duracionDias"))
    return quality.completeness(
        spans.select(late.alias("duracionDias")), [], "duracion", {"duracionDias": 0}
    )


@register
def check_orphans(spark, sf_dir):
    """Q6: rows whose key is missing elsewhere."""
    orders = b.table(spark, sf_dir, "orders")
    lines = b.table(spark, sf_dir, "lineitem")
    customer = b.table(spark, sf_dir, "customer")
    references = {
        "o_orderkey": (lines, "l_orderkey"),
        "o_custkey": (customer.filter("c_acctbal > 0"), "c_custkey"),
    }
    return quality.orphans(orders, references)


@register
def check_star(spark, sf_dir):
    """Q2, Q3, Q6 on the stored star."""
    return gold.gold_rules(marts.star(spark, sf_dir))


@register
def row_counts(spark, sf_dir):
    """Q7: rows per table and view."""
    star = marts.star(spark, sf_dir)
    named = {name: build(star) for name, build in views.VIEWS.items()}
    return quality.row_counts({**star.tables(), **named})


@register
def slice_sizes(spark, sf_dir):
    """Q8: rows of a slice with matches and of one without."""
    none = slices.Selection(years=())
    return quality.row_counts(
        {"elegido": _slice(spark, sf_dir, SOME), "vacio": _slice(spark, sf_dir, none)}
    )


@register
def slice_empty(spark, sf_dir):
    """Q8: whether a slice has rows, for one with matches and one without."""
    chosen = {"elegido": SOME, "vacio": slices.Selection(years=())}
    found = [(name, rows.is_empty(_slice(spark, sf_dir, selection))) for name, selection in chosen.items()]
    return spark.createDataFrame(found, "seleccion string, vacia boolean")


@register
def clean_optional_columns(spark, sf_dir):
    """Rules for columns the frame lacks do nothing."""
    few = b.bronze_tickets(spark, sf_dir).select("codigoFicha", "estado", "diagnostico")
    return silver.clean_columns(few, TICKET_RULES)


@register
def enforced_rules(spark, sf_dir):
    """Q5: a report with a violation raises, naming rule, column and count; one without does not."""
    reports = {
        "fichas": quality.completeness(b.repeated_tickets(spark, sf_dir), ["estado"], "estado presente"),
        "lineas": quality.uniqueness(
            b.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", *b.LINE_ORDER], "lineas unicas"
        ),
    }
    found = []
    for name, report in reports.items():
        try:
            quality.enforce(report)
            found.append((name, "ok"))
        except quality.QualityError as error:
            found.append((name, str(error)))
    return spark.createDataFrame(found, "tabla string, resultado string")


@register
def stored_document(spark, sf_dir):
    """IO10, Q1: counts taken while the tickets are written, as a document published with them."""
    store = TierStore(spark, f"{marts.store(spark, sf_dir).root}/document/{uuid4().hex}")
    run = store.run()
    counted = quality.Counted(marts.tickets(spark, sf_dir))
    run.write(runs.TICKETS, counted.df)
    run.write_document(runs.SUMMARY, quality.counted_summary({"fichas": counted}))
    run.publish()
    document = store.read_document(runs.SUMMARY)
    names = document.select("nulos_fichas.*").columns
    nulls = F.explode(F.create_map(*[x for c in names for x in (F.lit(c), F.col(f"nulos_fichas.{c}"))]))
    return document.select(F.col("filas_fichas").alias("filas"), nulls.alias("columna", "nulos"))


@register
def csv_by_header(spark, sf_dir):
    """IO4: files with their columns in different orders, matched by name."""
    path = f"{marts.store(spark, sf_dir).root}/csv/{uuid4().hex}"
    tickets = b.bronze_tickets(spark, sf_dir).select("codigoFicha", "estado", "indicaciones")
    odd = F.col("codigoFicha").cast("bigint") % 2 == 1
    landing.write_csv(tickets.filter(odd), path)
    turned = tickets.filter(~odd).select("indicaciones", "codigoFicha", "estado")
    landing.write_csv(turned, path, append=True)
    return landing.read_csv(spark, path, columns=tickets.columns)


@register
def silver_mixed_dates(spark, sf_dir):
    """Dates in several formats; a ticket whose date none of them reads goes."""
    clean = silver.clean_tickets(b.mixed_date_tickets(spark, sf_dir), b.as_of())
    return clean.select("codigoFicha", "fechaHoraReserva", "anio", "mes", "fecha")


@register
def check_unread_dates(spark, sf_dir):
    """Dates that no format reads."""
    return silver.unread_dates(b.mixed_date_tickets(spark, sf_dir), TICKET_RULES, "fechas leidas")


@register
def star_null_labels(spark, sf_dir):
    """Null labels have a key of their own, the highest, in dimension and fact."""
    key = F.col("codigoFicha").cast("bigint")
    tickets = marts.tickets(spark, sf_dir).withColumns(
        {
            "especialidad": F.when(key % 7 != 0, F.col("especialidad")),
            "canalReserva": F.when(key % 11 != 0, F.col("canalReserva")),
        }
    )
    dims = replace(
        marts.star(spark, sf_dir).dims,
        specialty=gold.specialty_dimension(tickets),
        channel=gold.channel_dimension(tickets),
    )
    fact = gold.visit_fact(tickets, dims).groupBy("especialidad_key", "canal_key").agg(F.count("*").alias("fichas"))
    return fact.join(dims.specialty, "especialidad_key").join(dims.channel, "canal_key")


@register
def lookup_fan_out(spark, sf_dir):
    """Rows that a lookup would repeat."""
    lines = b.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return quality.fan_out(b.table(spark, sf_dir, "orders"), lines, ["o_orderkey"], "pedido ambiguo")


@register
def check_campaigns(spark, sf_dir):
    """Rules of the campaign star, before and after its lookups."""
    campaigns, types = marts.campaigns(spark, sf_dir), marts.campaign_types(spark, sf_dir)
    centers = marts.star(spark, sf_dir).dims.center
    fact = gold.campaign_fact(campaigns, centers, types)
    return quality.merge_reports(
        gold.campaign_lookup_rules(campaigns, centers, types), gold.campaign_rules(fact, centers, types)
    )


@register
def published_run(spark, sf_dir):
    """IO8: readers see the last published run, not one that has not been."""
    store = TierStore(spark, f"{marts.store(spark, sf_dir).root}/published/{uuid4().hex}")
    store.write("t", b.table(spark, sf_dir, "nation"))
    store.write("t", b.table(spark, sf_dir, "region"))
    store.run().write("t", b.table(spark, sf_dir, "customer"))
    return store.read("t")
