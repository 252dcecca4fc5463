import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wattledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Values of column expressions over one row of given columns."""

    def run(row: dict, schema: str, *columns):
        df = spark.createDataFrame([tuple(row.values())], schema)
        return tuple(df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())

    return run
