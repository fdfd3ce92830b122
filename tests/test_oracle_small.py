"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from vaultline.plans.catalog import ORACLE, QUERIES
from vaultline.sources.fixtures import BASE_TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (decimal.Decimal, float)):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = df.collect()
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(df.columns, rows) == _bag(dcols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "financial_event_key" in df.columns


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(E.queries())
