"""Every registered query with an oracle equals DuckDB on the same parquet (sf0.001)."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_duckdb(spark, con, key):
    sdf = E.queries()[key](spark, SF001)
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(sdf.columns) == sorted(rel.columns)
    cols = sorted(sdf.columns)
    s_idx = [sdf.columns.index(c) for c in cols]
    o_idx = [rel.columns.index(c) for c in cols]
    a = sorted((tuple(_norm(r[i]) for i in s_idx) for r in sdf.collect()), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in o_idx) for r in rel.fetchall()), key=repr)
    assert a == b


def test_every_query_has_a_callable_and_entry_runs(spark):
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    out = E.entry(spark)
    assert out.columns == ["pickup_hour", "avgduration"]
    assert out.count() > 0
