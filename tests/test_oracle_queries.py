"""Every registered query against its DuckDB statement on the sf0.001 tables
(row count, column names, and the order-insensitive multiset of values)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from vireo.sources.tables import TABLES

QUERIES = E.queries()
ORACLES = E.oracle_sql()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_is_registered():
    assert len(QUERIES) >= 140
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(c.lower() for c in cols) == sorted(c.lower() for c in ocols)
    assert len(rows) == len(orows)
    assert _canon(cols, rows) == _canon(ocols, orows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["description", "sales", "trev", "cumrevenue", "cumper", "category"]
    assert df.count() > 0
