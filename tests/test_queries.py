"""Registered queries against their SQL on the smallest tables."""
import math

import duckdb
import pytest

import __spark_entry__ as entry
from marginwatch.plans.registry import QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = [n for n in entry.queries() if n in QUERIES]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return repr(round(v, 6) + 0.0) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    got = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    order = [cols.index(c) for c in sorted(cols)]
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in cur.fetchall())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
