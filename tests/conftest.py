import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clinicmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture()
def column(spark):
    """Evaluate a column function over literal values and return the results in order."""

    def run(values, function, schema):
        rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, {schema}")
        out = df.select("i", function(df).alias("out")).orderBy("i").collect()
        return [r.out for r in out]

    return run
