import json
from datetime import date
from decimal import Decimal

import pandas as pd
import pytest
from fixtures import (
    AS_OF, CAMPAIGN_SCHEMA, CAMPAIGNS, CENTER_SCHEMA, CENTERS, GOLDEN_CAMPAIGN_FACTS,
    GOLDEN_CENTERS, RECORD_SCHEMA, RECORDS, TICKET_SCHEMA, TICKETS,
)
from pyspark.sql import functions as F

from clinicmart.operators import quality
from clinicmart.plans import gold, runs, silver, slices, views
from clinicmart.plans.slices import Selection
from clinicmart.schema import FACT_COLUMNS, WIDE_COLUMNS
from clinicmart.sources.store import TierStore


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    return TierStore(spark, str(tmp_path_factory.mktemp("tiers")))


@pytest.fixture(scope="module")
def clean(spark, store):
    return runs.build_clean_tier(
        store,
        spark.createDataFrame(TICKETS, TICKET_SCHEMA),
        spark.createDataFrame(CAMPAIGNS, CAMPAIGN_SCHEMA),
        spark.createDataFrame(RECORDS, RECORD_SCHEMA),
        F.lit(AS_OF),
        ["orden"], ["orden"], ["orden"],
    )


@pytest.fixture(scope="module")
def star(spark, store, clean):
    centers = spark.createDataFrame(CENTERS, CENTER_SCHEMA)
    # Centre keys are complete here, but a null specialty and channel must join too.
    return runs.build_star(store, clean[runs.TICKETS], centers, clean[runs.INDICATOR])


def table(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_summary_document(store, clean):
    import glob

    text = "".join(open(p).read() for p in glob.glob(f"{store.root}/{runs.SUMMARY}/part-*"))
    summary = json.loads(text)
    assert (summary["filas_fichas"], summary["filas_campanas"], summary["filas_cepal"]) == (9, 3, 2)
    assert summary["nulos_fichas"]["especialidad"] == 1
    assert summary["nulos_fichas"]["tiempoEsperaMin"] == 5


def test_label_dimension_puts_null_last(star):
    got = table(star.dims.specialty.orderBy("especialidad_key"), "especialidad_key", "especialidad")
    assert got == [(1, "MEDICINA"), (2, "ÑANDÚ"), (3, None)]
    got = table(star.dims.channel.orderBy("canal_key"), "canal_key", "canalReserva")
    assert got == [(1, "WEB"), (2, None)]


def test_center_dimension_golden_order(spark):
    shuffled = [r[1:] for r in GOLDEN_CENTERS][::-1] + [GOLDEN_CENTERS[0][1:]]
    source = spark.createDataFrame(shuffled, CENTER_SCHEMA)
    got = table(gold.center_dimension(source).orderBy("centro_key"), "*")
    assert got == GOLDEN_CENTERS


def test_calendar(star):
    got = table(star.dims.calendar.orderBy("fecha_key"), "*")
    assert got[0] == (20240101, date(2024, 1, 1), 2024, 1, 1, "ENERO", 1, 1, "LUNES")
    assert [r[0] for r in got] == [20240101, 20250203, 20251231]
    assert got[2][3:] == (4, 12, "DICIEMBRE", 31, 3, "MIERCOLES")


def test_context(star):
    got = table(star.dims.context.orderBy("contexto_key"), "*")
    assert got == [(1, 2021, "BOLIVIA", 4.0), (2, 2024, "BOL", 12.5)]


def test_context_has_one_row_per_year(spark):
    rows = [(2001, "B", 2.0), (2000, " bolivia", 1.0), (2000, "a", 3.0), (2001, "B", 2.0)]
    got = gold.context_dimension(spark.createDataFrame(rows, "anio int, pais string, valor_cepal double"))
    assert table(got.orderBy("contexto_key"), "*") == [(1, 2000, "BOLIVIA", 1.0), (2, 2001, "B", 2.0)]


def test_fact(star):
    assert star.fact.columns == list(FACT_COLUMNS)
    rows = star.fact.orderBy("atencion_key").collect()
    assert [r.atencion_key for r in rows] == list(range(1, 10))
    assert [r.codigoFicha for r in rows] == ["F1", "F2", "F3", "F5", "F7", "F6", "F9", "F10", "F11"]
    by_code = {r.codigoFicha: r for r in rows}
    assert by_code["F3"].especialidad_key == 3 and by_code["F7"].canal_key == 2
    assert by_code["F1"].contexto_key == 2 and by_code["F9"].contexto_key is None
    flags = [(r.esAtendida, r.esAusente, r.esCancelada, r.esReservada) for r in rows]
    assert all(sum(f) == 1 for f in flags)
    assert {r.conteoFicha for r in rows} == {1}


def test_star_passes_and_fails_its_rules(star):
    quality.enforce(gold.gold_rules(star))
    broken = gold.Star(
        star.dims, star.fact.withColumn("centro_key", F.when(F.col("atencion_key") > 1, 99))
    )
    report = {(r.regla, r.columna): r.violaciones for r in gold.gold_rules(broken).collect()}
    assert report[("claves completas", "centro_key")] == 1
    assert report[("referencia", "centro_key")] == 9
    assert report[("referencia", "contexto_key")] == 0


def test_build_star_refuses_a_missing_center(spark, clean, tmp_path):
    centers = spark.createDataFrame(CENTERS[1:], CENTER_SCHEMA)
    with pytest.raises(quality.QualityError, match=r"centro_key\]: 2"):
        runs.build_star(
            TierStore(spark, str(tmp_path)), clean[runs.TICKETS], centers, clean[runs.INDICATOR]
        )


def test_load_star(star, store):
    again = runs.load_star(store)
    assert list(again.tables()) == [
        "DimTiempo", "DimCentroSalud", "DimEspecialidad", "DimCanal", "DimEstado",
        "DimContextoCEPAL", "FactAtenciones",
    ]
    assert again.fact.count() == star.fact.count()


def test_campaign_star_matches_golden_facts(spark, store, clean):
    centers = spark.createDataFrame(
        GOLDEN_CENTERS,
        "centro_key bigint, " + CENTER_SCHEMA,
    )
    types, fact = runs.build_campaign_star(store, clean[runs.CAMPAIGNS], centers)
    assert table(types.orderBy("tipo_campana_key"), "tipo") == [
        ("NUTRICIÓN",), ("RESPIRATORIA",), ("VACUNACIÓN",),
    ]
    got = {tuple(r)[1:] for r in fact.collect()}
    assert got == GOLDEN_CAMPAIGN_FACTS
    assert sorted(r.campana_key for r in fact.collect()) == [1, 2, 3]


def test_wide(star):
    wide = gold.star_wide(star)
    assert wide.columns == list(WIDE_COLUMNS)
    assert wide.count() == 9
    null_label = wide.filter("especialidad is null").collect()
    assert len(null_label) == 1 and null_label[0].valor_cepal == 12.5
    assert gold.star_wide(star, years=[2025]).count() == 6
    assert gold.star_wide(star, years=[]).count() == 0


# ---------------------------------------------------------------------- views


def test_general_kpis(star):
    got = views.general_kpis(star).first().asDict()
    # 3 attended, 4 absent, 1 cancelled, 1 reserved; capacity 2 on three days, 0 on one.
    assert got == {
        "tasa_ausentismo_pct": Decimal("50.00"),
        "tiempo_promedio_espera_min": Decimal("21.00"),
        "indice_saturacion_promedio_pct": Decimal("116.67"),
        "total_fichas": 9, "total_atendidas": 3, "total_ausentes": 4,
        "total_canceladas": 1, "total_reservadas": 1,
    }


def test_general_kpis_of_nothing_is_one_row_of_nulls(star):
    empty = gold.Star(star.dims, star.fact.filter("false"))
    row = views.general_kpis(empty).collect()
    assert len(row) == 1 and set(row[0]) == {None}


def test_daily_saturation(star):
    got = {
        (r.fecha, r.centroSalud): (r.total_fichas_dia, r.indice_saturacion_pct)
        for r in views.daily_saturation(star).collect()
    }
    assert got == {
        (date(2024, 1, 1), "CENTRO A"): (3, Decimal("150.00")),
        (date(2025, 2, 3), "CENTRO A"): (1, Decimal("50.00")),
        (date(2025, 2, 3), "CENTRO B"): (2, None),
        (date(2025, 12, 31), "CENTRO A"): (3, Decimal("150.00")),
    }


def test_noshow_by_specialty(star):
    got = {tuple(r) for r in views.noshow_by_specialty(star).collect()}
    assert got == {
        ("MEDICINA", 6, 4, Decimal("66.67")), ("ÑANDÚ", 2, 0, Decimal("0.00")),
        (None, 1, 0, Decimal("0.00")),
    }


def test_monthly_series(star):
    got = {(r.anio, r.mes): r for r in views.monthly_series(star).collect()}
    assert set(got) == {(2024, 1), (2025, 2), (2025, 12)}
    jan = got[(2024, 1)]
    assert (jan.total_fichas, jan.total_atendidas, jan.total_ausentes, jan.total_canceladas) == (
        3, 1, 1, 1,
    )
    # The cancelled ticket waited 50 minutes, but only attended ones count here.
    assert jan.espera_promedio_min == Decimal("10.00") and jan.valor_cepal == 12.5
    assert got[(2025, 12)].valor_cepal is None


def test_registered_views_answer_sql(spark, star):
    views.register_views(star)
    for name in views.VIEWS:
        assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] > 0
    rate = spark.sql(
        "SELECT tasa_ausentismo_pct FROM vw_ausentismo_especialidad WHERE especialidad = 'MEDICINA'"
    ).first()[0]
    assert rate == Decimal("66.67")
    assert spark.table("FactAtenciones").count() == 9


def test_rates_of_ties_round_half_up(spark, star):
    base = star.fact.limit(1).drop("esAusente")
    rows = base.crossJoin(spark.range(800).select((F.col("id") < 1).cast("int").alias("esAusente")))
    got = views.noshow_by_specialty(gold.Star(star.dims, rows.select(*FACT_COLUMNS))).first()
    assert got.tasa_ausentismo_pct == Decimal("0.13")


# --------------------------------------------------------------------- slices


@pytest.fixture(scope="module")
def wide(star):
    return slices.slice_star(star, Selection(), ("atencion_key",)).persist()


def test_default_selection_leaves_out_unknown_labels(wide):
    assert wide.count() == 8
    assert wide.filter("especialidad is null").count() == 0


def test_selection(star):
    def codes(selection):
        return slices.slice_star(star, selection).count()

    assert codes(Selection(years=[2025])) == 6
    assert codes(Selection(years=[2025], centers=["CENTRO B"])) == 2
    assert codes(Selection(specialties=["ÑANDÚ"])) == 2
    assert codes(Selection(centers=[])) == 0
    assert slices.no_rows(slices.slice_star(star, Selection(years=[])))
    assert not slices.no_rows(slices.slice_star(star, Selection()))


def test_filter_options(star):
    got = table(slices.filter_options(gold.star_wide(star)), "*")
    assert got == [
        ("anio", "2024"), ("anio", "2025"), ("centroSalud", "CENTRO A"),
        ("centroSalud", "CENTRO B"), ("especialidad", "MEDICINA"), ("especialidad", "ÑANDÚ"),
    ]


def kpis(star, selection):
    row = slices.kpi_row(
        slices.slice_star(star, selection), slices.star_saturation(star, selection)
    )
    return row, row.first().asDict()


def test_kpi_row(star):
    row, got = kpis(star, Selection())
    assert got == {
        "total_fichas": 8, "total_atendidas": 3, "total_ausentes": 4, "total_canceladas": 0,
        "total_cerradas": 7, "tasa_ausentismo": 57.14, "espera_promedio": 21.0,
        "tasa_atencion": 37.5, "indice_saturacion": 116.7,
    }
    assert tuple(slices.kpi_bands(row).first()) == (57.14, "Crítico", 116.7, "Sobrecarga")


def test_kpi_row_saturation_ignores_the_specialty(star):
    _, got = kpis(star, Selection(years=[2025], specialties=["ÑANDÚ"]))
    assert got["total_fichas"] == 2 and got["indice_saturacion"] == 100.0


def test_kpi_row_of_nothing(star):
    _, got = kpis(star, Selection(years=[]))
    assert got == {
        "total_fichas": 0, "total_atendidas": 0, "total_ausentes": 0, "total_canceladas": 0,
        "total_cerradas": 0, "tasa_ausentismo": 0.0, "espera_promedio": None,
        "tasa_atencion": 0.0, "indice_saturacion": 0.0,
    }
    _, only_zero = kpis(star, Selection(centers=["CENTRO B"]))
    assert only_zero["indice_saturacion"] is None


def test_saturation_of_rounded_days_differs_from_unrounded(spark, star):
    """One and three tickets at a capacity of 7: 14.2857 and 42.857 against 14.29 and 42.86."""
    center = star.dims.center.limit(1).withColumn("capacidadDiaria", F.lit(7).cast("bigint"))
    dims = gold.Dimensions.from_tables({**star.dims.tables(), "DimCentroSalud": center})
    one = star.fact.limit(1).withColumn("centro_key", F.lit(center.first().centro_key))
    days = spark.createDataFrame([(20240101,)] + [(20250203,)] * 3, "d bigint")
    fact = one.crossJoin(days).withColumn("fecha_key", F.col("d")).select(*FACT_COLUMNS)
    small = gold.Star(dims, fact)
    assert views.general_kpis(small).first().indice_saturacion_promedio_pct == Decimal("28.57")
    rounded = views.daily_saturation(small).agg(F.sum("indice_saturacion_pct")).first()[0] / 2
    assert rounded == Decimal("28.575")
    assert slices.saturation_by_center(views.daily_saturation(small)).first()[1] == 28.6


def test_series_and_distributions(wide):
    assert table(slices.monthly(wide), "*") == [
        (2024, 1, 2, 1, 1, 0, "2024-01"), (2025, 2, 3, 1, 1, 0, "2025-02"),
        (2025, 12, 3, 1, 2, 0, "2025-12"),
    ]
    assert table(slices.state_distribution(wide), "*") == [
        ("AUSENTE", 4, 50.0), ("ATENDIDA", 3, 37.5), ("RESERVADA", 1, 12.5),
    ]
    # The ticket without a channel is in no group.
    assert table(slices.channel_distribution(wide), "*") == [("WEB", 7)]
    assert table(slices.noshow(wide), "*") == [("ÑANDÚ", 2, 0, 0.0), ("MEDICINA", 6, 4, 66.67)]


def test_drills(wide):
    got = table(slices.drill_specialty(wide, "MEDICINA"), "*")
    assert got == [
        ("CENTRO B", 1, 0, 1, 0, 0.0, 100.0, None),
        ("CENTRO A", 5, 2, 3, 0, 40.0, 60.0, 15.0),
    ]
    upward = table(slices.drill_specialty(wide, "MEDICINA", descending=False), "centroSalud")
    assert upward == [("CENTRO A",), ("CENTRO B",)]
    got = table(slices.drill_center(wide, "CENTRO B"), "*")
    assert got == [
        ("MEDICINA", 1, 0, 1, 0, 0.0, 100.0, None), ("ÑANDÚ", 1, 1, 0, 0, 100.0, 0.0, 33.0),
    ]
    assert slices.drill_center(wide, "NADIE").count() == 0
    assert slices.display(slices.drill_center(wide, "CENTRO B")).columns == [
        "Especialidad", "Fichas", "Atendidas", "Ausentes", "Canceladas", "Atención %",
        "Ausentismo %", "Espera (min)",
    ]


def test_drill_wait_counts_every_ticket_that_has_one(star):
    wide = gold.star_wide(star).fillna("NINGUNA", ["especialidad"])
    drilled = slices.drill_specialty(wide, "NINGUNA").first()
    assert drilled.espera_prom == 50.0
    assert slices.wait_by_specialty(wide).filter("especialidad = 'NINGUNA'").count() == 0


def test_saturation_wait_and_context(star, wide):
    saturation = slices.star_saturation(star, Selection())
    assert table(slices.saturation_by_center(saturation), "*") == [
        ("CENTRO A", 116.7), ("CENTRO B", None),
    ]
    assert table(slices.wait_by_specialty(wide), "*") == [("ÑANDÚ", 33.0), ("MEDICINA", 15.0)]
    assert table(slices.demand_and_context(wide), "*") == [(2024, 2, 12.5), (2025, 6, None)]


def test_detail(wide):
    assert tuple(slices.detail_header(wide).first()) == (8, 2, 2, 2024, 2025)
    rows = slices.detail_rows(wide).collect()
    assert [r.fecha for r in rows] == sorted((r.fecha for r in rows), reverse=True)
    assert len(rows) == 8 and len(rows[0]) == 9
    assert tuple(slices.detail_header(wide.filter("false")).first()) == (0, 0, 0, None, None)


def test_measures_against_brute_force(spark, star, wide):
    """The same figures from plain pandas over the collected slice."""
    pdf = wide.toPandas()
    want = (
        pdf.groupby(["especialidad", "centroSalud"], as_index=False)
        .agg(n=("conteoFicha", "sum"), a=("esAusente", "sum"))
        .assign(rate=lambda d: (d.a / d.n * 100).round(1))
    )
    for label, group in want.groupby("especialidad"):
        got = slices.drill_specialty(wide, label).toPandas()
        merged = group.merge(got, on="centroSalud")
        assert len(merged) == len(group) == len(got)
        pd.testing.assert_series_equal(
            merged["rate"], merged["tasa_ausentismo"], check_names=False
        )


def test_silver_and_gold_do_not_read_python(spark, star, clean):
    for df in (gold.star_wide(star), views.general_kpis(star)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan


def test_extracts(spark):
    from clinicmart.plans import extract

    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    tables = {
        "FichaMedica": frame(
            [("F1", 1, 7, 3, 5), ("F2", 2, 7, 3, 5), ("F3", 9, 7, 3, 5)],
            "codigoFicha string, idPaciente int, idMedico int, idEspecialidad int, idCentro int",
        ).withColumns(
            {
                c: F.lit(None).cast("string")
                for c in (
                    "fechaHoraReserva", "fechaHoraAtencion", "estado", "prioridad",
                    "canalReserva", "tiempoEsperaMin", "motivoReprogramacion",
                    "resultadoAtencion", "indicaciones", "diagnostico",
                )
            }
        ),
        "Paciente": frame(
            [(1, 11, "F", None), (2, 12, "M", None)],
            "idPaciente int, idUsuario int, sexo string, fechaNacimiento date",
        ),
        "Usuario": frame(
            [(11, "ana"), (12, "eva"), (13, "luis")], "idUsuario int, nombreCompleto string"
        ),
        "Medico": frame([(7, 13)], "idMedico int, idUsuario int"),
        "Especialidad": frame([(3, "medicina")], "idEspecialidad int, nombre string"),
        "CentroSalud": frame(
            [(5, 4, "centro", 10)],
            "idCentro int, idGeografia int, nombre string, capacidadDiaria int",
        ),
        "Geografia": frame(
            [(4, "d", "c", "z", "a")],
            "idGeografia int, departamento string, ciudad string, zona string, area string",
        ),
    }
    got = extract.extract_tickets(tables)
    named = table(got.orderBy("codigoFicha"), "codigoFicha", "nombrePaciente", "nombreMedico",
                  "especialidad", "centroSalud", "ciudad")
    assert named == [
        ("F1", "ana", "luis", "medicina", "centro", "c"),
        ("F2", "eva", "luis", "medicina", "centro", "c"),
    ]
    assert table(extract.extract_centers(tables), "*") == [("centro", "c", "d", "a", 10)]


def test_silver_module_has_rules_for_all_tables():
    assert silver.TICKET_RULES.key == ("codigoFicha",)
    assert silver.CAMPAIGN_RULES.key == ("codigoCampana",)


def test_summary_gives_the_same_slices(spark, star, tmp_path):
    summed = gold.summarise(star)
    stored = gold.Star(star.dims, TierStore(spark, str(tmp_path)).write("s", summed.fact))
    assert stored.fact.count() < star.fact.count()
    for selection in (Selection(), Selection(years=[2025]), Selection(centers=[])):
        wide, small = slices.slice_star(star, selection), slices.slice_star(stored, selection)
        for function in (
            slices.monthly, slices.state_distribution, slices.channel_distribution,
            slices.noshow, slices.wait_by_specialty, slices.demand_and_context,
            slices.detail_header, slices.filter_options,
            lambda df: slices.drill_specialty(df, "MEDICINA"),
            lambda df: slices.drill_center(df, "CENTRO B"),
        ):
            assert table(function(small), "*") == table(function(wide), "*")
        assert kpis(stored, selection)[1] == kpis(star, selection)[1]


def test_summary_gives_the_same_views(spark, star, tmp_path):
    # Every ticket twice, so that each combination of keys stands for several tickets.
    doubled = gold.Star(star.dims, star.fact.unionAll(star.fact))
    summed = TierStore(spark, str(tmp_path)).write("s", gold.summarise(doubled).fact)
    assert summed.count() < doubled.fact.count()
    for name, build in views.VIEWS.items():
        rows, small = table(build(doubled), "*"), table(build(gold.Star(star.dims, summed)), "*")
        assert sorted(small, key=str) == sorted(rows, key=str), name


def test_from_landed_files_to_acceptance(spark, tmp_path):
    from fixtures import CAMPAIGN_SCHEMA, CAMPAIGNS, TICKET_SCHEMA, TICKETS

    from clinicmart.sources import landing

    folder = str(tmp_path / "bronze")
    for name, rows, schema in (
        (runs.LANDED_TICKETS, TICKETS, TICKET_SCHEMA),
        (runs.LANDED_CAMPAIGNS, CAMPAIGNS, CAMPAIGN_SCHEMA),
    ):
        # One file, so that the order of rows in the file is the order of arrival.
        ordered = spark.createDataFrame(rows, schema).coalesce(1).sortWithinPartitions("orden")
        landing.write_csv(ordered.drop("orden"), f"{folder}/{name}")
    records = [{"dim_1": d, "value": v, "iso3": c} for _, d, v, c in RECORDS]
    (tmp_path / "bronze" / runs.LANDED_FEED).write_text(json.dumps({"body": {"data": records}}))

    store = TierStore(spark, str(tmp_path / "tiers"))
    clean = runs.clean_landed(spark, store, folder, F.lit(AS_OF))
    assert "_ingest_order" not in clean[runs.TICKETS].columns
    centers = spark.createDataFrame(CENTERS, CENTER_SCHEMA)
    star = runs.build_star(store, clean[runs.TICKETS], centers, clean[runs.INDICATOR])
    got = dict(table(runs.accept(store), "*"))
    assert got[runs.TICKETS] == got["FactAtenciones"] == 9
    assert got["vw_kpis_generales"] == 1 and got["vw_saturacion_diaria"] == 4

    runs.export_csv(star.tables(), str(tmp_path / "gold"))
    back = landing.read_csv(spark, str(tmp_path / "gold" / "FactAtenciones.csv"))
    assert back.columns == list(FACT_COLUMNS) and back.count() == 9


def test_acceptance_needs_every_table(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)path"):
        runs.accept(TierStore(spark, str(tmp_path)))


def test_extracts_are_landed(spark, tmp_path):
    from clinicmart.sources import landing
    from registry import bindings

    sf_dir = "/root/testdata/sf0.001"
    tables = bindings.ticket_sources(spark, sf_dir)
    tables["CampanaMedica"] = bindings.campaign_sources(spark, sf_dir)["CampanaMedica"]
    runs.land_extracts(tables, str(tmp_path))
    back = landing.read_csv(spark, str(tmp_path / runs.LANDED_TICKETS))
    assert back.count() == 1500 and len(back.columns) == 24


# ---------------------------------------------------------------- publication


@pytest.mark.parametrize("kind", ["folder", "database"])
def test_a_run_that_fails_leaves_the_tables_before_it(spark, tmp_path, kind):
    if kind == "database":
        spark.sql(f"CREATE DATABASE IF NOT EXISTS pub_mart LOCATION '{tmp_path}/pub'")
        store = TierStore(spark, database="pub_mart")
    else:
        store = TierStore(spark, str(tmp_path / "tiers"))
    try:
        tickets = spark.createDataFrame(TICKETS, TICKET_SCHEMA)
        campaigns = spark.createDataFrame(CAMPAIGNS, CAMPAIGN_SCHEMA)
        records = spark.createDataFrame(RECORDS, RECORD_SCHEMA)
        centers = spark.createDataFrame(CENTERS, CENTER_SCHEMA)
        golden = spark.createDataFrame(GOLDEN_CENTERS, "centro_key bigint, " + CENTER_SCHEMA)
        orders = (["orden"],) * 3
        clean = runs.build_clean_tier(store, tickets, campaigns, records, F.lit(AS_OF), *orders)
        runs.build_star(store, clean[runs.TICKETS], centers, clean[runs.INDICATOR])
        runs.build_campaign_star(store, clean[runs.CAMPAIGNS], golden)
        before = store.published()

        backwards = campaigns.withColumns({"fechaInicio": F.col("fechaFin"), "fechaFin": F.col("fechaInicio")})
        with pytest.raises(quality.QualityError, match="duracionDias"):
            runs.build_clean_tier(store, tickets.limit(1), backwards, records, F.lit(AS_OF), *orders)
        with pytest.raises(quality.QualityError, match="centro_key"):
            runs.build_star(store, clean[runs.TICKETS].limit(5), centers.limit(1), clean[runs.INDICATOR])
        twice = golden.unionByName(golden.withColumn("centro_key", F.col("centro_key") + 100))
        with pytest.raises(quality.QualityError, match="centro ambiguo"):
            runs.build_campaign_star(store, clean[runs.CAMPAIGNS], twice)

        assert store.published() == before
        assert store.read(runs.TICKETS).count() == runs.load_star(store).fact.count() == 9
        assert store.read(runs.CAMPAIGN_FACT).count() == 3
        if kind == "database":
            assert spark.table("pub_mart.FactAtenciones").count() == 9
    finally:
        if kind == "database":
            spark.sql("DROP DATABASE pub_mart CASCADE")


def test_acceptance_covers_campaigns(spark, tmp_path):
    store = TierStore(spark, str(tmp_path))
    clean = runs.build_clean_tier(
        store, spark.createDataFrame(TICKETS, TICKET_SCHEMA), spark.createDataFrame(CAMPAIGNS, CAMPAIGN_SCHEMA),
        spark.createDataFrame(RECORDS, RECORD_SCHEMA), F.lit(AS_OF), ["orden"], ["orden"], ["orden"],
    )
    star = runs.build_star(
        store, clean[runs.TICKETS], spark.createDataFrame(CENTERS, CENTER_SCHEMA), clean[runs.INDICATOR]
    )
    types, fact = runs.build_campaign_star(store, clean[runs.CAMPAIGNS], star.dims.center)
    got = dict(table(runs.accept(store), "*"))
    assert (got[runs.CAMPAIGN_FACT], got[runs.CAMPAIGN_TYPES]) == (3, types.count())
    store.write(runs.CAMPAIGN_FACT, fact.withColumn("tipo_campana_key", F.lit(99).cast("bigint")))
    with pytest.raises(quality.QualityError, match=r"tipo_campana_key\]: 3"):
        runs.accept(store)


def test_unread_dates_of_a_run(store, clean):
    found = {(r.tabla, r.columna): r.no_leidas for r in store.read_document(runs.UNREAD).collect()}
    # The chosen row of F4 has a date that cannot be read, and is dropped for it.
    assert found[(runs.TICKETS, "fechaHoraReserva")] == 1 and found[(runs.CAMPAIGNS, "fechaInicio")] == 0


# ----------------------------------------------------------- plans of the star


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_joins_once_after_numbering(clean, star):
    fact = gold.visit_fact(clean[runs.TICKETS], star.dims)
    text = plan(fact)
    assert text.count("rangepartitioning") == 0 and text.count("_place") > 0


SELECTIONS = [
    Selection(), Selection(years=[2025]), Selection(years=()), Selection(centers=["CENTRO A"]),
    Selection(specialties=["MEDICINA"]), Selection(years=[2024, 2025], centers=["CENTRO A", "CENTRO B"], specialties=["ÑANDÚ"]),
]


@pytest.mark.parametrize("selection", SELECTIONS)
def test_headline_from_one_scan(star, selection):
    _, expected = kpis(star, selection)
    row = slices.headline(star, selection)
    assert row.first().asDict() == expected and row.columns == list(expected)
    assert plan(row).count("FactAtenciones") <= 1
    summed = gold.summarise(star)
    assert slices.headline(summed, selection).first().asDict() == expected


@pytest.mark.parametrize("selection", SELECTIONS)
def test_groups_give_the_same_slices(star, selection):
    wide = slices.slice_star(star, selection)

    def groups(*by):
        return slices.slice_groups(star, selection, by)

    for function, by in (
        (slices.monthly, ("anio", "mes")),
        (slices.state_distribution, ("estado",)),
        (slices.channel_distribution, ("canalReserva",)),
        (slices.noshow, ("especialidad",)),
        (slices.wait_by_specialty, ("especialidad", "estado")),
        (slices.demand_and_context, ("anio", "valor_cepal")),
        (slices.detail_header, ("anio", "centroSalud", "especialidad")),
        (lambda df: slices.drill_specialty(df, "MEDICINA"), ("especialidad", "centroSalud")),
        (lambda df: slices.drill_center(df, "CENTRO B"), ("especialidad", "centroSalud")),
    ):
        assert table(function(groups(*by)), "*") == table(function(wide), "*")


def test_groups_read_what_they_need(star):
    text = plan(slices.channel_distribution(slices.slice_groups(star, Selection(years=[2025]), ["canalReserva"])))
    assert "DimEstado" not in text and "DimContexto" not in text
    options = slices.filter_options(slices.slice_groups(star, None, ["anio", "centroSalud", "especialidad"]))
    assert table(options, "*") == table(slices.filter_options(gold.star_wide(star)), "*")
    assert "DimCanal" not in plan(options)
