"""SCD2 dimension stored by key bucket (K2, K3): a merge rewrites only what a delivery changes.

Layout: ``is_history=0|1/key_bucket=n``. Current versions of a key lie in its
bucket under ``is_history=0``; closed versions under ``is_history=1``, where files are
only ever added. A merge

1. finds the buckets that hold a key whose delivered row differs (one join of the delivery
   with the current versions; history is not read),
2. merges the current versions of those buckets with their delivered rows (``scd2.scd2_merge``),
3. writes the result to a hidden folder of the table and checks its rows,
4. adds the new files and moves the old current files of these buckets away, by a journal of
   moves that the next merge, or a compaction, finishes if a run ends in between.

A delivery that changes nothing writes nothing. New files come before old ones go, so a
reader in between may see a key's old and new version, never none. One
merge at a time is assumed, as for every table here.

The bucket count may change between merges: keys that are stored keep being found by
the bucket they lie in, and rows that are rewritten move to their new one. Of a key with
NULL delivered nothing is merged (``scd2.scd2_rejects``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import scd2 as K
from . import maintenance as MT
from .writers import write_table

LAYOUT = ["is_history", "key_bucket"]
BUCKETS = 64


def laid_out(dim: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Versions with the partition columns of the store; a NULL flag counts as closed."""
    current = F.coalesce(F.col("is_current"), F.lit(False))
    return dim.withColumns({"is_history": (~current).cast("int"),
                            "key_bucket": F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")})


def versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions, without the columns of the layout."""
    return spark.read.parquet(path).drop(*LAYOUT)


def merge(spark: SparkSession, path: str, delivery: DataFrame, key: str, as_of: date | str | Column,
          tracked: Sequence[str] | None = None, mode: str = "on_change", buckets: int = BUCKETS) -> dict:
    """First load, or merge of a delivery into the stored dimension. Returns rows, touched buckets and replaced files."""
    MT.recover(spark, path)
    MT.finish_compaction(spark, path)
    if not MT.path_exists(spark, path):
        rows = MT.publish_swap(spark, laid_out(K.scd2_initial(delivery, as_of), key, buckets), path, LAYOUT, cluster_by=[key])
        return {"rows": rows, "buckets": buckets, "files_replaced": 0}
    if not set(LAYOUT) <= set(spark.read.parquet(path).columns):  # a table of before is laid out once
        MT.publish_swap(spark, laid_out(spark.read.parquet(path), key, buckets), path, LAYOUT, cluster_by=[key])
    columns = [*delivery.columns, *K.META]
    current = spark.read.parquet(path).where("is_history = 0").select(*columns, "key_bucket")
    placed = _placed(delivery, current, key, as_of, tracked, mode, buckets)
    touched = [r[0] for r in placed.where("changed").select("bucket").distinct().collect()]  # at most one per bucket
    done = {"rows": 0, "buckets": len(touched), "files_replaced": 0}
    if touched:
        old = current.where(F.col("key_bucket").isin(touched)).drop("key_bucket")
        rows = placed.where(F.col("bucket").isin(touched) & (F.col("stored") | F.col("changed"))).select(*delivery.columns)
        merged = K.scd2_merge(old, rows, key, as_of, tracked, mode)
        done["files_replaced"] = _publish(spark, path, laid_out(merged, key, buckets), touched, key)
    return done | {"rows": spark.read.parquet(path).count()}


def _placed(delivery: DataFrame, current: DataFrame, key: str, as_of, tracked: Sequence[str] | None, mode: str,
            buckets: int) -> DataFrame:
    """Delivered rows with the bucket of their key, whether the key is stored, and whether it may get a new version."""
    names = list(tracked or [c for c in delivery.columns if c != key])
    now = current.select(F.col(key).alias("c__key"), F.struct(*names).alias("c__row"), F.col("effective_date").alias("c__from"),
                         F.col("key_bucket").alias("c__bucket"))
    met = delivery.where(F.col(key).isNotNull()).join(now, F.col(key) == F.col("c__key"), "left")
    stored = F.col("c__key").isNotNull()
    same = F.lit(False) if mode == "always" else reduce(and_, [F.col("c__row")[c].eqNullSafe(F.col(c)) for c in names], F.lit(True))
    # a row older than the stored version is taken along, so that the merge refuses it
    older = F.col("c__from") > (as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date"))
    return met.select(*delivery.columns, stored.alias("stored"), (~stored | ~same | older).alias("changed"),
                      F.coalesce("c__bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).alias("bucket"))


def _publish(spark: SparkSession, path: str, merged: DataFrame, touched: Sequence[int], key: str) -> int:
    """Put the merged versions in the place of the touched buckets' current files; closed versions are added. Returns the files replaced."""
    home = path.rstrip("/")
    work = f"{home}/_compact-{uuid.uuid4().hex[:8]}"
    before = MT.list_files(spark, {"t": path}).where(
        F.col("path").contains("/is_history=0/")
        & F.regexp_extract("path", "/key_bucket=([0-9]+)/", 1).cast("int").isin(list(touched))).select("path").collect()
    seen = Observation("merged")
    write_table(merged, f"{work}/new", LAYOUT, cluster_by=[key], observation=seen)
    if spark.read.parquet(f"{work}/new").count() != int(seen.get["rows"]):
        MT.remove_path(spark, work)
        raise MT.PublishError(f"row check failed for the merge into {path}")
    new = MT.list_files(spark, {"t": f"{work}/new"}).select("path").collect()
    moves = [(r["path"], f"{home}/{r['path'].split('/new/', 1)[1]}") for r in new]
    moves += [(r["path"], f"{work}/old/{i}") for i, r in enumerate(before)]
    MT.move_files(spark, path, work, moves)
    return len(before)
