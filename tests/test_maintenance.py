import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from strata.plans import maintenance as MT
from strata.plans.writers import write_table


def _files(path):
    return sorted(glob.glob(os.path.join(path, "**", "*.parquet"), recursive=True))


def _small_table(spark, path):
    rows = [(i, ["a", "b", None][i % 3], dt.datetime(2024, 1, 1 + i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, part string, ts timestamp_ntz")
    write_table(df, path, ["part"], max_records_per_file=7)
    return df


def test_compaction_keeps_rows_and_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    _small_table(spark, path)
    before = len(_files(path))
    stats = MT.compact(spark, path, ["part"], cluster_by=["id"], target_files=3)
    after = _files(path)
    assert stats["rows"] == 300 and len(after) < before
    df = spark.read.parquet(path)
    counts = {r.part: r["count"] for r in df.groupBy("part").count().collect()}
    assert counts == {"a": 100, "b": 100, None: 100}
    assert any("__HIVE_DEFAULT_PARTITION__" in f for f in after)
    assert not glob.glob(path + ".__*")  # no staging or backup left behind


def test_backfill_replaces_only_its_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "orders")
    rows = [(i, dt.datetime(2024, 1 + i % 3, 5)) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz").withColumn("month", F.month("ts"))
    write_table(df, path, ["month"])
    untouched = {f: os.path.getmtime(f) for f in _files(path) if "month=1" in f or "month=3" in f}
    changed = df.withColumn("id", F.col("id") + 1000)
    MT.backfill(changed, path, "ts", "2024-02-01", "2024-02-29", ["month"])
    after = spark.read.parquet(path)
    assert after.count() == 30
    assert after.filter("month = 2").agg(F.min("id")).first()[0] >= 1000
    assert after.filter("month = 1").agg(F.max("id")).first()[0] < 1000
    for f, m in untouched.items():
        assert os.path.exists(f) and os.path.getmtime(f) == m


def test_date_slice_inclusive_and_pushed_down(spark, tmp_dir):
    path = os.path.join(tmp_dir, "s")
    rows = [(1, dt.datetime(2024, 1, 31, 23, 59)), (2, dt.datetime(2024, 2, 1, 0, 0)), (3, dt.datetime(2024, 1, 1))]
    spark.createDataFrame(rows, "id long, ts timestamp_ntz").write.parquet(path)
    df = MT.date_slice(spark.read.parquet(path), "ts", "2024-01-01", "2024-01-31")
    assert sorted(r.id for r in df.collect()) == [1, 3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_upsert_replaces_and_inserts(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(tuple(r) for r in MT.upsert(t, s, ["k"]).collect()) == [(1, "a"), (2, "B"), (3, "C")]


def test_incremental_slice(spark):
    df = spark.createDataFrame([(1,), (5,), (10,)], "w int")
    assert [r.w for r in MT.incremental_slice(df, "w", 1, 10).collect()] == [5, 10]


def test_publish_swap_and_readiness(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pub")
    n = MT.publish_swap(spark, spark.range(10), path)
    n2 = MT.publish_swap(spark, spark.range(20), path)  # replaces the old content
    assert (n, n2, spark.read.parquet(path).count()) == (10, 20, 20)
    r = {x.table_name: x for x in MT.readiness(spark, {"pub": path, "missing": path + "_nope"}).collect()}
    assert r["pub"].ready and r["pub"].rows == 20 and not r["missing"].ready
    inv = MT.inventory(spark, {"pub": path}).first()
    assert inv.rows == 20 and inv.n_files >= 1 and inv.bytes > 0


def test_expired_partitions(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 30),)], "d date") \
        .withColumn("day", F.dayofmonth("d"))
    got = {r.day: r.expired for r in MT.expired_partitions(df, ["day"], F.col("d"), 10, "2024-02-01").collect()}
    assert got == {1: True, 30: False}


def test_compaction_refuses_row_loss(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "guard")
    _small_table(spark, path)
    real = MT.write_table

    def lossy(df, p, *a, **k):
        real(df.limit(10), p, *a, **k)
    monkeypatch.setattr(MT, "write_table", lossy)
    with pytest.raises(MT.PublishError):
        MT.compact(spark, path, ["part"])
    assert spark.read.parquet(path).count() == 300


def test_partition_pruning_and_optional_scan(spark, tmp_dir):
    from strata.plans.pipeline import read_optional
    from strata.sources import contracts as C
    path = os.path.join(tmp_dir, "pp")
    df = spark.createDataFrame([(i, 2020 + i % 3) for i in range(30)], "id long, year int")
    write_table(df, path, ["year"])
    q = spark.read.parquet(path).filter("year = 2021")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and q.count() == 10
    empty = read_optional(spark, os.path.join(tmp_dir, "nope"), C.EVENTS)
    assert empty.count() == 0 and empty.schema == C.EVENTS


def test_retention_deletes_only_expired_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "events")
    rows = [(i, dt.date(2024, 1, 1 + i % 30)) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, d date").withColumn("day", F.dayofmonth("d"))
    write_table(df, path, ["day"])
    t = spark.read.parquet(path)
    exp = MT.expired_partitions(t, ["day"], F.col("d"), 20, "2024-02-01").filter("expired")
    removed = MT.delete_partitions(spark, path, exp, ["day"])
    assert removed == sorted(f"day={d}" for d in range(1, 12))
    left = spark.read.parquet(path)
    assert left.count() == 90 - 11 * 3 and left.agg(F.min("day")).first()[0] == 12


def _hash(df):
    return sorted(map(str, df.collect()))


def test_compaction_rewrites_small_files_only_and_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    rows = [(i, "007" if i % 10 else "8", "x" * 50) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, part string, v string")
    write_table(df.where("part = '8'").coalesce(1), path, ["part"])
    write_table(df.where("part = '007'").repartition(30), path, ["part"], mode="append")
    big = _files(path + "/part=8")
    sizes = sum(os.path.getsize(f) for f in _files(path + "/part=007"))
    before = {f: os.path.getmtime(f) for f in big}
    target = sizes // 4
    stats = MT.compact(spark, path, target_bytes=target, cluster_by=["id"])
    after = _files(path)
    assert stats["files_rewritten"] == 30 and stats["files_before"] == 31 and stats["files_after"] == len(after)
    heavy = [f for f in after if "part=007" in f]  # the folder keeps its name, the heavy partition has several files
    assert 3 <= len(heavy) <= 5 and {f: os.path.getmtime(f) for f in big} == before
    read = spark.read.schema("id long, v string, part string").parquet(path)
    assert _hash(read.select("id", "part", "v")) == _hash(df)
    times = {f: os.path.getmtime(f) for f in after}
    again = MT.compact(spark, path, target_bytes=max(os.path.getsize(f) for f in heavy))
    assert again["rows"] == again["files_rewritten"] == 0
    assert {f: os.path.getmtime(f) for f in _files(path)} == times
    assert not [f for f in os.listdir(path) if f.startswith("_compact")]


@pytest.mark.parametrize("moves", [0, 1, 5, 12])
def test_interrupted_compaction_is_finished(spark, tmp_dir, monkeypatch, moves):
    path = os.path.join(tmp_dir, "t")
    df = spark.range(1000).withColumn("p", F.col("id") % 2)
    write_table(df.repartition(6), path, ["p"])
    real, made = MT._fs, []

    class Stopped(Exception):
        pass

    class Fs:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            if name == "rename":
                if len(made) == moves:
                    raise Stopped
                made.append(1)
            return getattr(self.fs, name)

    monkeypatch.setattr(MT, "_fs", lambda s, p: (lambda f, q: (Fs(f), q))(*real(s, p)))
    with pytest.raises(Stopped):
        MT.compact(spark, path)
    monkeypatch.setattr(MT, "_fs", real)
    MT.finish_compaction(spark, path)
    assert _hash(spark.read.parquet(path).select("id")) == _hash(df.select("id"))
    assert len(_files(path)) == 2 and MT.compact(spark, path)["files_rewritten"] == 0


def test_file_facts_keep_missing_and_empty_tables(spark, tmp_dir):
    import pyarrow.parquet as pq
    full, empty, folder = (os.path.join(tmp_dir, n) for n in ("full", "empty", "folder"))
    _small_table(spark, full)
    spark.range(0).coalesce(1).write.parquet(empty)
    os.makedirs(folder)
    tables = {"full": full, "empty": empty, "folder": folder, "missing": full + "_no", "one": _files(full)[0]}
    facts = {r.file_path: r for r in MT.file_stats(spark, {"full": full}).collect()}
    want = {f: (os.path.getsize(f), pq.read_metadata(f).num_rows) for f in _files(full)}
    assert {k.removeprefix("file:"): (r.bytes, r.rows) for k, r in facts.items()} == want
    ages = [(r.modified - dt.datetime(1970, 1, 1)).total_seconds() - os.path.getmtime(k.removeprefix("file:")) for k, r in facts.items()]
    assert max(map(abs, ages)) < 1  # the session's zone is UTC
    inv = {r.table_name: (r.n_files, r.rows) for r in MT.inventory(spark, tables).collect()}
    assert inv == {"full": (len(want), 300), "empty": (1, 0), "folder": (0, 0), "missing": (0, 0), "one": (1, inv["one"][1])}
    ready = {r.table_name: r.ready for r in MT.readiness(spark, tables).collect()}
    assert ready == {"full": True, "empty": True, "folder": False, "missing": False, "one": True}
    fresh = {r.table_name: (r.n_files, r.mean_age_seconds) for r in MT.freshness(spark, tables, "2100-01-01 00:00:00").collect()}
    assert fresh["missing"] == (0, None) and fresh["folder"] == (0, None) and fresh["empty"][1] > 0
    assert MT.freshness(spark, {"missing": full + "_no"}, "2100-01-01").count() == 1
    assert MT.readiness(spark, {"missing": full + "_no"}).first().ready is False
    plan = MT.file_stats(spark, {"full": full})._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    listing = MT.freshness(spark, {"full": full}, "2100-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" not in listing
