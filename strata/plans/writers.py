"""Table writers: partitioned / external / dynamic-overwrite Parquet writes.

File-count control: with ``cluster_by`` the rows are rebalanced on the partition
columns (the cluster columns if there are none) before the write: adaptive
execution splits a heavy partition value over several tasks and merges small
ones, from the sizes of the shuffle itself, so nothing is sampled or computed
twice. With ``num_partitions`` they are range-partitioned into that many. ``max_records_per_file`` caps file size. Dynamic partition overwrite
is a per-write option, never a session setting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, mode: str = "overwrite",
                dynamic: bool = False, cluster_by: Sequence[str] | None = None,
                num_partitions: int | None = None, max_records_per_file: int | None = None,
                table_name: str | None = None, fmt: str = "parquet", observation: Observation | None = None) -> None:
    """``observation`` (a row count, named ``rows``) is attached after the
    clustering step, so a sampling pass of range partitioning is not counted."""
    out = df
    if cluster_by is not None:
        cols = [*(partition_by or []), *cluster_by]
        out = out.repartitionByRange(num_partitions, *cols) if num_partitions \
            else out.hint("rebalance", *(partition_by or cluster_by))
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    w = out.write.format(fmt).mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    if table_name:
        w.option("path", path).saveAsTable(table_name)
    else:
        w.save(path)
