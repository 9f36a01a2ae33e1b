"""Dimension stored by key bucket: equal to the plain merge, untouched files stay, a stopped merge is finished."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from strata.operators import scd2 as K
from strata.plans import maintenance as MT
from strata.plans import scd2_store as SS

DDL = "id long, city string, state string"


def rows_of(df):
    return sorted(map(repr, df.select("id", "city", "state", *K.META).collect()))


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(os.path.join(path, "is_history=*", "**", "*.parquet"), recursive=True)}


def load(spark, path, n=200):
    first = spark.createDataFrame([(i, f"c{i}", "A") for i in range(n)], DDL)
    SS.merge(spark, path, first, "id", "2024-01-01", buckets=8)
    return K.scd2_initial(first, "2024-01-01")


def test_deliveries_equal_the_plain_merge(spark, tmp_dir):
    path = os.path.join(tmp_dir, "dim")
    plain = load(spark, path)
    days = [("2024-02-01", [(3, "new", "A"), (500, "c", None), (3, "other", "A"), (None, "x", "x")]),
            ("2024-02-01", [(3, None, "B"), (7, "c7", "A")]),       # same day again, one row without a change
            ("2024-03-01", [(i, f"m{i}", "B") for i in range(0, 200, 3)] + [(3, "new", "A")]),
            ("2024-03-02", [])]
    for buckets, (day, delivered) in zip((8, 8, 5, 8), days):       # another bucket count in between
        delivery = spark.createDataFrame(delivered, DDL)
        plain = spark.createDataFrame(K.scd2_merge(plain, delivery, "id", day).collect(), plain.schema)
        got = SS.merge(spark, path, delivery, "id", day, buckets=buckets)
        assert rows_of(spark.read.parquet(path)) == rows_of(plain) and got["rows"] == plain.count()
    dim = spark.read.parquet(path)
    assert rows_of(K.scd2_current(dim)) == rows_of(K.scd2_current(plain))
    plan = K.scd2_current(dim)._jdf.queryExecution().executedPlan().toString()
    assert "is_history" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_only_touched_buckets_change_and_history_is_never_rewritten(spark, tmp_dir):
    path = os.path.join(tmp_dir, "dim")
    load(spark, path)
    SS.merge(spark, path, spark.createDataFrame([(i, "n", "A") for i in range(200)], DDL), "id", "2024-02-01", buckets=8)
    before = files(path)
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(5).cast("long")), F.lit(8))).first()[0]
    got = SS.merge(spark, path, spark.createDataFrame([(5, "x", "A"), (6, "n", "A")], DDL), "id", "2024-03-01", buckets=8)
    after = files(path)
    assert got["buckets"] == 1
    gone = set(before) - set(after)
    assert gone and all(f"is_history=0/key_bucket={bucket}/" in f for f in gone)
    assert all(after[f] == before[f] for f in set(before) & set(after))
    same = SS.merge(spark, path, spark.createDataFrame([(5, "x", "A")], DDL), "id", "2024-04-01", buckets=8)
    assert (same["buckets"], same["files_replaced"]) == (0, 0) and files(path) == after


@pytest.mark.parametrize("stop_at", range(5))
def test_stopped_merge_is_finished_by_the_next(spark, tmp_dir, monkeypatch, stop_at):
    path = os.path.join(tmp_dir, "dim")
    plain = load(spark, path, 20)
    delivery = spark.createDataFrame([(1, "x", "A"), (2, "y", "A")], DDL)
    want = rows_of(K.scd2_merge(plain, delivery, "id", "2024-02-01"))
    real = MT.finish_compaction

    def some_moves(spark, path):
        """Only the first moves of the journal, as if the run had ended then; with none, it ends before the journal is whole."""
        for work in glob.glob(os.path.join(path, "_compact-*")):
            steps = spark.read.parquet(f"{work}/journal").orderBy("step").collect()
            for r in steps[:max(0, stop_at - 1)]:
                source, target = (r[c].removeprefix("file:") for c in ("source", "target"))
                os.makedirs(os.path.dirname(target), exist_ok=True)
                os.rename(source, target)
            if stop_at == 0:
                os.remove(f"{work}/journal/_SUCCESS")
            raise KeyboardInterrupt
        return 0

    monkeypatch.setattr(MT, "finish_compaction", some_moves)
    with pytest.raises(KeyboardInterrupt):
        SS.merge(spark, path, delivery, "id", "2024-02-01", buckets=8)
    monkeypatch.setattr(MT, "finish_compaction", real)
    SS.merge(spark, path, delivery, "id", "2024-02-01", buckets=8)
    assert rows_of(spark.read.parquet(path)) == want and not glob.glob(os.path.join(path, "_compact-*"))


def test_table_of_before_is_laid_out_and_an_older_delivery_refused(spark, tmp_dir):
    path = os.path.join(tmp_dir, "dim")
    old = K.scd2_initial(spark.createDataFrame([(i, "c", "A") for i in range(9)], DDL), "2024-01-01")
    old.write.partitionBy("state").parquet(path)
    delivery = spark.createDataFrame([(1, "x", "A")], DDL)
    SS.merge(spark, path, delivery, "id", "2024-02-01")
    assert rows_of(SS.versions(spark, path)) == rows_of(K.scd2_merge(old, delivery, "id", "2024-02-01"))
    with pytest.raises(Exception, match="as_of lies before"):
        SS.merge(spark, path, delivery, "id", "2023-12-01")


def test_row_mix_in_a_touched_bucket_keeps_keys_of_other_buckets(spark, tmp_dir):
    """Delivered rows without a change, whose buckets are not touched, get no second version."""
    path = os.path.join(tmp_dir, "dim")
    load(spark, path, 60)
    delivery = spark.createDataFrame([(i, f"c{i}" if i else "moved", "A") for i in range(61)], DDL)
    SS.merge(spark, path, delivery, "id", "2024-02-01", buckets=8)
    per = spark.read.parquet(path).groupBy("id").count()
    assert {r["id"]: r["count"] for r in per.where("count > 1").collect()} == {0: 2} and per.count() == 61
