import pytest
from fixtures import (
    AS_OF, CAMPAIGN_SCHEMA, CAMPAIGNS, CLEAN_CAMPAIGNS, RECORD_SCHEMA, RECORDS, TICKET_SCHEMA,
    TICKETS,
)
from pyspark.sql import functions as F

from clinicmart.operators import quality
from clinicmart.plans import silver
from clinicmart.schema import CAMPAIGN_COLUMNS, TICKET_COLUMNS


@pytest.fixture(scope="module")
def tickets(spark):
    bronze = spark.createDataFrame(TICKETS, TICKET_SCHEMA)
    return silver.clean_tickets(bronze, F.lit(AS_OF), ["orden"])


def test_ticket_columns(tickets):
    assert tickets.columns == [
        "orden", *TICKET_COLUMNS, "anio", "mes", "dia", "fecha", "edad_aprox",
    ]


def test_ticket_rows(tickets):
    got = {r.codigoFicha: r for r in tickets.collect()}
    # F4 goes with its first row, F8 has no state, one ticket has no code.
    assert set(got) == {"F1", "F2", "F3", "F5", "F6", "F7", "F9", "F10", "F11"}
    assert got["F1"].estado == "ATENDIDA" and got["F1"].resultadoAtencion == "CONSULTA RESUELTA"
    assert got["F2"].estado == "AUSENTE" and got["F2"].diagnostico == "IRA"
    assert got["F2"].fecha.isoformat() == "2024-01-01"
    assert got["F3"].especialidad is None and got["F3"].zona == "SIN DATO"
    assert got["F5"].tiempoEsperaMin is None and got["F5"].edad_aprox == 0
    assert got["F1"].edad_aprox == 45 and got["F1"].tiempoEsperaMin == 10.0
    assert (got["F6"].anio, got["F6"].mes, got["F6"].dia) == (2025, 2, 3)
    assert got["F9"].canalReserva == "WEB" and got["F7"].canalReserva is None


def test_missing_columns_are_skipped(spark):
    few = spark.createDataFrame(
        [("F1", "2024-01-01", "atendida", "a", None)],
        "codigoFicha string, fechaHoraReserva string, estado string, centroSalud string, "
        "fechaNacimiento string",
    )
    got = silver.clean_tickets(few, F.lit(AS_OF)).first()
    assert got.estado == "ATENDIDA" and got.anio == 2024


def test_campaigns_match_golden_rows(spark):
    bronze = spark.createDataFrame(CAMPAIGNS, CAMPAIGN_SCHEMA)
    clean = silver.clean_campaigns(bronze, ["orden"])
    got = {tuple(r) for r in clean.select(*CAMPAIGN_COLUMNS, "duracionDias").collect()}
    assert got == CLEAN_CAMPAIGNS


def test_indicator(spark):
    records = spark.createDataFrame(RECORDS, RECORD_SCHEMA)
    got = {tuple(r) for r in silver.clean_indicator(records, ["orden"]).collect()}
    # The gap of 2024 does not hide the good value after it.
    assert got == {(2024, "BOL", 12.5), (2021, "BOLIVIA", 4.0)}


def test_indicator_without_country_is_home(spark):
    records = spark.createDataFrame([(1, 29170, 1.5)], "orden int, year bigint, value double")
    assert tuple(silver.clean_indicator(records, ["orden"]).first()) == (2000, "BOL", 1.5)
    with pytest.raises(ValueError, match="no value column"):
        silver.clean_indicator(records.drop("value"), ["orden"])
    with pytest.raises(ValueError, match="no year column"):
        silver.clean_indicator(records.drop("year"), ["orden"])


def test_silver_rules(spark, tickets):
    campaigns = silver.clean_campaigns(
        spark.createDataFrame(CAMPAIGNS, CAMPAIGN_SCHEMA), ["orden"]
    )
    indicator = silver.clean_indicator(spark.createDataFrame(RECORDS, RECORD_SCHEMA), ["orden"])
    quality.enforce(silver.silver_rules(tickets, campaigns, indicator))
    backwards = campaigns.withColumn("duracionDias", F.lit(-1).cast("bigint"))
    with pytest.raises(quality.QualityError, match=r"duracionDias>=0\]: 3"):
        quality.enforce(silver.silver_rules(tickets, backwards, indicator))


# ---------------------------------------------------------------------- dates

SPELLED = [
    ("F1", "2025-03-15 08:30:00"), ("F2", "15/03/2025 8:30:00"), ("F3", "5/3/2025 08:30"), ("F4", "15/03/2025"),
    ("F5", "15-03-2025 08:30"), ("F6", "03/15/2025"), ("F7", "mañana"), ("F8", None), ("F9", " "),
]


@pytest.fixture()
def spelled(spark):
    return spark.createDataFrame(SPELLED, "codigoFicha string, fechaHoraReserva string").withColumns(
        {"estado": F.lit("atendida"), "centroSalud": F.lit("a"), "fechaNacimiento": F.lit("1/2/1980")}
    )


def test_dates_in_several_formats(spelled):
    got = {r.codigoFicha: r for r in silver.clean_tickets(spelled, F.lit(AS_OF)).collect()}
    assert set(got) == {"F1", "F2", "F3", "F4", "F5"}
    days = {k: r.fechaHoraReserva.isoformat(sep=" ", timespec="minutes") for k, r in got.items()}
    assert days == {
        "F1": "2025-03-15 08:30", "F2": "2025-03-15 08:30", "F3": "2025-03-05 08:30",
        "F4": "2025-03-15 00:00", "F5": "2025-03-15 08:30",
    }
    assert {r.fechaNacimiento.isoformat()[:10] for r in got.values()} == {"1980-02-01"}


def test_other_formats_by_rule(spelled):
    from dataclasses import replace

    from clinicmart.schema import TICKET_RULES

    month_first = replace(TICKET_RULES, formats=("M/d/yyyy",))
    got = {r.codigoFicha for r in silver.clean_tickets(spelled, F.lit(AS_OF), rules=month_first).collect()}
    assert got == {"F1", "F6"}


def test_unread_dates_are_counted(spark, spelled, tmp_path):
    from clinicmart.schema import TICKET_RULES

    report = {r.columna: r.violaciones for r in silver.unread_dates(spelled, TICKET_RULES, "r").collect()}
    assert report == {"fechaHoraReserva": 2, "fechaNacimiento": 0}
    unread = silver.UnreadDates()
    clean = silver.clean_tickets(spelled, F.lit(AS_OF), unread=unread)
    clean.write.parquet(str(tmp_path / "t"))
    # Counted while the rows were written, before those without a date went.
    assert unread.counts() == {"fechaHoraReserva": 2, "fechaNacimiento": 0}


def test_repeated_keys_need_an_order(spark):
    rows = [("F1", "2024-01-01", "atendida", "a"), ("F1", "2024-01-02", "atendida", "a")]
    df = spark.createDataFrame(rows, "codigoFicha string, fechaHoraReserva string, estado string, centroSalud string")
    df = df.withColumn("fechaNacimiento", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="no order is stated"):
        silver.clean_tickets(df, F.lit(AS_OF)).collect()
    assert silver.clean_tickets(df, F.lit(AS_OF), ["fechaHoraReserva"]).first().dia == 1
    assert silver.clean_tickets(df.limit(1), F.lit(AS_OF)).count() == 1
