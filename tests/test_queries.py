"""Every registered query against its SQL on the smallest tables, and the shape of every plan."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tenderloom import catalog
from tenderloom.sources.bindings import TABLES

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = catalog.QUERIES, catalog.ORACLE
BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def text(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    return repr(round(v, 6)) if isinstance(v, float) else str(v)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [b for b in BANNED if b in plan]
    cols = sorted(df.columns)
    rows = sorted(tuple(text(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    assert rows == sorted(tuple(text(r[i]) for i in idx) for r in cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
