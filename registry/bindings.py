"""The test tables presented in the shape of the service's source tables.

No test table holds a null, a duplicate ticket or untidy text, so the bindings
put them there by fixed rules over the keys. The same rules stand as SQL in
``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinicmart.operators.joins import broadcast_if_small
from clinicmart.schema import TICKET_COLUMNS

AS_OF = "2001-12-31"
LAST_CONTEXT_YEAR = 2000
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
IDEOGRAPHIC_SPACE = "　"


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


# Stated rather than inferred, which would be one more job per table.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def untidy(col: Column) -> Column:
    """Lower case, with white space of several kinds around."""
    return F.concat(F.lit(" \t"), F.lower(col), F.lit(f"{IDEOGRAPHIC_SPACE} "))


def _state() -> Column:
    early = F.substring("o_orderpriority", 1, 1).isin("1", "2", "3")
    return (
        F.when(F.col("o_orderstatus") == "F", F.lit("atendida"))
        .when(F.col("o_orderstatus") == "O", F.lit("reservada"))
        .when(early, F.lit("ausente"))
        .otherwise(F.lit("cancelada"))
    )


def _birth() -> Column:
    days = (F.col("c_custkey") % 25_000).cast("int")
    born = F.date_add(F.lit("1940-01-01").cast("date"), days)
    return F.when(F.col("c_custkey") % 50 != 0, born)


def centers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Centres and places from nations and regions."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return {
        "CentroSalud": nation.select(
            F.col("n_nationkey").alias("idCentro"),
            F.col("n_nationkey").alias("idGeografia"),
            F.lower("n_name").alias("nombre"),
            (F.col("n_nationkey") % 4).cast("bigint").alias("capacidadDiaria"),
        ),
        "Geografia": places.select(
            F.col("n_nationkey").alias("idGeografia"),
            F.lower("r_name").alias("departamento"),
            F.col("n_name").alias("ciudad"),
            F.when(F.col("n_nationkey") % 2 == 0, F.lit("norte")).alias("zona"),
            F.lit("urbana").alias("area"),
        ),
    }


def ticket_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The normalised tables behind the ticket extract."""
    customer = table(spark, sf_dir, "customer")
    attended = F.col("estado") == "atendida"
    tickets = table(spark, sf_dir, "orders").withColumn("estado", _state())
    waits = attended | (F.col("estado") == "cancelada")
    key = F.col("o_orderkey")
    return {
        **centers(spark, sf_dir),
        "FichaMedica": tickets.select(
            key.cast("string").alias("codigoFicha"),
            F.col("o_orderdate").alias("fechaHoraReserva"),
            F.when(attended, F.col("o_orderdate") + F.expr("INTERVAL '1' HOUR")).alias(
                "fechaHoraAtencion"
            ),
            "estado",
            F.col("o_orderpriority").alias("prioridad"),
            F.col("o_orderpriority").alias("canalReserva"),
            F.when(waits, (F.floor("o_totalprice") % 120).cast("double")).alias("tiempoEsperaMin"),
            F.when(F.col("estado") == "cancelada", F.lit("viaje")).alias("motivoReprogramacion"),
            F.when(attended & (key % 2 == 0), F.lit("atencion exitosa"))
            .when(attended, F.lit("derivado"))
            .alias("resultadoAtencion"),
            F.when(key % 3 == 0, F.lit("reposo")).alias("indicaciones"),
            F.when(key % 3 == 1, F.lit("Infeccion respiratoria aguda"))
            .when(key % 3 == 2, F.lit("gripe"))
            .alias("diagnostico"),
            F.col("o_custkey").alias("idPaciente"),
            (F.col("o_custkey") % 10).alias("idMedico"),
            (key % 5).cast("int").alias("idEspecialidad"),
            (F.col("o_custkey") % 25).cast("int").alias("idCentro"),
        ),
        "Paciente": customer.select(
            F.col("c_custkey").alias("idPaciente"),
            F.col("c_custkey").alias("idUsuario"),
            F.when(F.col("c_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("sexo"),
            _birth().alias("fechaNacimiento"),
        ),
        "Usuario": customer.select(
            F.col("c_custkey").alias("idUsuario"), F.col("c_name").alias("nombreCompleto")
        ),
        "Medico": table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("idMedico"), F.col("s_suppkey").alias("idUsuario")
        ),
        "Especialidad": table(spark, sf_dir, "region").select(
            F.col("r_regionkey").alias("idEspecialidad"), F.col("r_name").alias("nombre")
        ),
    }


def bronze_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets as extracted, untidy: one per order; segment as specialty, nation as centre."""
    sources = ticket_sources(spark, sf_dir)
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("idPaciente"),
        F.col("c_name").alias("nombrePaciente"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("sexo"),
        _birth().alias("fechaNacimiento"),
        untidy(F.col("c_mktsegment")).alias("especialidad"),
        F.col("c_nationkey").alias("idCentro"),
    )
    places = (
        sources["CentroSalud"]
        .join(sources["Geografia"], "idGeografia")
        .withColumnRenamed("nombre", "centroSalud")
        .drop("idGeografia")
    )
    return (
        sources["FichaMedica"]
        .drop("idEspecialidad", "idCentro")
        .withColumns(
            {
                "estado": untidy(F.col("estado")),
                "canalReserva": untidy(F.col("canalReserva")),
                "nombreMedico": F.concat(F.lit("doctor "), F.col("idMedico").cast("string")),
            }
        )
        .join(customer, "idPaciente")
        .join(broadcast_if_small(places), "idCentro")
        .select(*TICKET_COLUMNS)
    )


def repeated_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line, so tickets repeat; small quantities lose the state.

    Line columns give the order the rows came in.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", *LINE_ORDER)
    tickets = bronze_tickets(spark, sf_dir)
    joined = lines.withColumn("codigoFicha", F.col("l_orderkey").cast("string")).join(
        tickets, "codigoFicha"
    )
    state = F.when(F.col("l_quantity") >= 10, F.col("estado"))
    return joined.withColumn("estado", state).select(*TICKET_COLUMNS, *LINE_ORDER)


def campaign_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Campaigns from order lines; the key repeats, some rows lack state or links."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    number = F.col("l_linenumber")
    campaigns = lines.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), number.cast("string")).alias(
            "codigoCampana"
        ),
        F.lower("p_type").alias("tipo"),
        untidy(F.col("p_name")).alias("titulo"),
        F.col("p_brand").alias("descripcion"),
        F.when(number % 3 == 0, F.concat(F.lit("  https://img.example/"), F.col("p_partkey"), F.lit(" ")))
        .when(number % 3 == 1, F.lit(" nan "))
        .alias("imagenUrl"),
        F.col("l_shipdate").alias("fechaInicio"),
        F.date_add("l_shipdate", F.col("l_quantity").cast("int")).alias("fechaFin"),
        F.lit("plaza").alias("lugar"),
        F.when(F.col("l_tax") >= 0.04, F.lit("carnet")).alias("requisitos"),
        F.when(F.col("l_returnflag") == "A", F.lit("familias")).alias("publicoObjetivo"),
        F.when(F.col("l_discount") > 0.01, F.col("l_linestatus")).alias("estado"),
        (F.col("l_suppkey") % 25).cast("int").alias("idCentro"),
        *LINE_ORDER,
    )
    return {**centers(spark, sf_dir), "CampanaMedica": campaigns}


def yearly_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed records of the yearly indicator: quantity shipped per year, coded years."""
    lines = table(spark, sf_dir, "lineitem")
    year = F.year("l_shipdate")
    return (
        lines.filter(F.col("l_shipdate") < F.lit("2001-01-01").cast("timestamp_ntz"))
        .groupBy(year.alias("y"))
        .agg(F.sum("l_quantity").cast("bigint").cast("string").alias("value"))
        .select((F.col("y") + 27_170).alias("dim_29117"), "value", F.lit(" bol").alias("iso3"))
    )


def repeated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per year and return flag: gaps first, other countries last, mixed year codes."""
    lines = table(spark, sf_dir, "lineitem")
    grouped = lines.groupBy(F.year("l_shipdate").alias("y"), "l_returnflag").agg(
        F.sum("l_quantity").cast("bigint").cast("string").alias("total")
    )
    odd = F.col("y") % 2 == 1
    flag = F.col("l_returnflag")
    return grouped.select(
        F.when(odd, F.col("y") + 27_170).otherwise(F.col("y")).cast("string").alias("dim_29117"),
        F.when((flag == "A") & odd, F.lit("sin dato")).otherwise(F.col("total")).alias("value"),
        F.when(flag == "A", F.lit(" bol"))
        .when(flag == "N", F.lit("Bolivia\t"))
        .otherwise(F.lit("arg"))
        .alias("iso3"),
        flag.alias("orden"),
    )


def mixed_date_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets as text files have them: reservations in three spellings, and some in none."""
    key, when = F.col("codigoFicha").cast("bigint"), F.col("fechaHoraReserva")
    spelled = (
        F.when(key % 8 == 3, F.lit("sin fecha"))
        .when(key % 4 == 1, F.date_format(when, "d/M/yyyy H:mm:ss"))
        .when(key % 4 == 2, F.date_format(when, "dd-MM-yyyy HH:mm"))
        .otherwise(when.cast("string"))
    )
    return bronze_tickets(spark, sf_dir).withColumn("fechaHoraReserva", spelled)
