"""Every registered query runs on the smallest fixture, matches its oracle SQL,
and plans without Python UDFs, cartesian products or nested-loop joins."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from strata.plans.registry import REGISTRY
from tools.check_oracle import TABLES, rows_key

# The corpus queries have tests of their own and may be absent.
QUERIES = {name: fn for name, fn in E.queries().items() if name in REGISTRY}
ORACLE = {name: sql for name, sql in E.oracle_sql().items() if name in REGISTRY}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_revenue" in df.columns


def test_every_query_has_oracle_or_is_file_metadata():
    rows_only = {n for n in QUERIES if n not in ORACLE}
    assert rows_only == {"file_inventory", "freshness", "readiness", "view_file_latency"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name} plans {bad}"
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert len(rows) > 0
        return
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_key(df.columns, rows, False) == rows_key(cols, cur.fetchall(), False)


def test_query_names():
    import re
    for name in QUERIES:
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name), name
        assert "pipeline" not in name and not re.match(r"op\d+_", name), name
