"""The driver contract: entry(), queries() and oracle_sql(), checked against DuckDB at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, rows_key

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "i94yr" in df.columns


def test_every_query_has_an_oracle():
    """Each query of the star library has one; the optional modules' queries are added beside them."""
    from starloom.plans.registry import ORACLE, QUERIES
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols, got = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert rows_key(cols, got) == rows_key(ocols, exp)
