"""Every registered query against its SQL counterpart on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_module  # noqa: E402
from check_oracles import TABLES, compare  # noqa: E402

from registry.oracles import all_oracles  # noqa: E402
from registry.queries import all_queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
# The analytics queries; those of the package for training data have tests of their own.
QUERIES = all_queries()
ORACLES = all_oracles()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) <= set(entry_module.queries())
    assert not [n for n in QUERIES if n == "pipeline" or n.startswith("op")]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    line, ok = compare(spark, con, SF_DIR, name, QUERIES[name], ORACLES.get(name))
    assert ok, line


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["especialidad", "total_fichas", "total_ausentes", "tasa_ausentismo_pct"]
    assert df.count() == 5


NOT_PYTHON = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_stays_in_the_jvm_and_has_no_cross_join(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in NOT_PYTHON)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_year_choice_reaches_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        df = QUERIES["kpi_row_chosen"](spark, SF_DIR)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan" in line and "FactAtenciones" in line]
    # Totals and saturation come from one scan.
    assert len(scans) == 1
    for scan in scans:
        assert "GreaterThanOrEqual(fecha_key,19960000)" in scan.split("PushedFilters:")[1]


def test_views_read_few_columns(spark):
    plan = QUERIES["noshow_specialty"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<especialidad_key:bigint,esAusente:int,conteoFicha:int>" in plan
