"""Registered queries against their SQL over the smallest tables."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from check_oracles import TABLES, compare  # noqa: E402

from clinicmart.llm.queries import all_oracles, all_queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in all_queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    line, ok = compare(spark, con, SF_DIR, name, all_queries()[name], all_oracles()[name])
    assert ok, line
