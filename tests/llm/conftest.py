import pytest

from clinicmart.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("llm-tests", "local[8]", **{"spark.sql.shuffle.partitions": "4"})
    yield session
