"""As-of join: against brute force, hot times, ties, NULLs, empty sides."""

import datetime as dt
import random

import pytest

from strata.operators.asof import asof_join

T0 = dt.datetime(2024, 1, 1)
LEFT, RIGHT = "id long, ts timestamp, v string", "at timestamp, t double, n long"


def brute(left, right, tolerance):
    out = []
    for i, ts, v in left:
        ok = [r for r in right if ts is not None and r[0] is not None and r[0] <= ts and (ts - r[0]).total_seconds() <= tolerance]
        best = max(ok, default=None)
        out.append((i, ts, v, best[1] if best else None, best[2] if best else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("bucket, slot", [(86_400, 1_000_000), (3600, 7), (600, 1)])
def test_against_brute_force(spark, bucket, slot):
    rng = random.Random(bucket)
    left = [(i, T0 + dt.timedelta(seconds=rng.randrange(3 * 86_400), microseconds=rng.randrange(10**6)), rng.choice("ab")) for i in range(300)]
    left += [(900 + i, T0 + dt.timedelta(hours=5), "hot") for i in range(150)] + [(7, None, None), (1, T0 - dt.timedelta(days=400), "old")]
    left += left[:3]
    right = [(T0 + dt.timedelta(minutes=rng.randrange(3 * 1440)), rng.random(), j) for j in range(60)]
    right += [(T0 + dt.timedelta(hours=5), 1.0, 1), (T0 + dt.timedelta(hours=5), 2.0, 0), (None, 9.0, 9)]
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "ts", "at", ["t", "n"], 3600, bucket, slot)
    assert got.columns == ["id", "ts", "v", "t", "n"]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(left, right, 3600)


def test_empty_sides(spark):
    left, right = spark.createDataFrame([(1, T0, "a")], LEFT), spark.createDataFrame([(T0, 1.0, 1)], RIGHT)
    assert [r.t for r in asof_join(left, right.limit(0), "ts", "at", ["t"], 60).collect()] == [None]
    assert asof_join(left.limit(0), right, "ts", "at", ["t"], 60).collect() == []
    assert [r.t for r in asof_join(left, right, "ts", "at", ["t"], 0).collect()] == [1.0]


def test_no_pairwise_join_and_split_hours(spark):
    left = spark.range(1000).selectExpr("id", "timestamp'2024-01-01 05:00:00' + make_dt_interval(0, 0, 0, id % 60) AS ts", "cast(id as string) AS v")
    right = spark.createDataFrame([(T0 + dt.timedelta(hours=h), 1.0, h) for h in range(24)], RIGHT)
    df = asof_join(left, right, "ts", "at", ["n"], 3600, rows_per_slot=50)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert {r.n for r in df.collect()} == {5}
