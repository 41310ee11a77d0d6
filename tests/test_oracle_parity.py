"""Every registered query with a SQL twin equals DuckDB on the smallest TESTDATA."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from shoplake.plans import registry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SQL = registry.ORACLE_SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def test_every_query_has_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 52


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _norm(srows, df.columns) == _norm(orows, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_revenue" in df.columns
