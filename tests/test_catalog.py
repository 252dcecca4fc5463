"""Every registered query against its SQL on the smallest data set."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "scripts"))

import __spark_entry__ as entry  # noqa: E402
from compare import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name not in entry.oracle_sql():
        assert got
        return
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert not [d[0] for d in cur.description if "HUGEINT" in str(d[1])]
    assert rows_of(df.columns, got) == rows_of(columns, cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).limit(5).count() == 5


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
