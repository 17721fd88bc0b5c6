"""Driver contract: entry() smoke, query/oracle key parity, oracle equality at sf0.001."""

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_mod
from fulfilq.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["orders", "lineitem", "customer"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "total_orders" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry_mod.queries()) and set(QUERIES) <= set(entry_mod.oracle_sql())
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry_mod.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _canon(df.columns, s_rows) == _canon(d_cols, cur.fetchall())
