"""Batch ∪ stream order table ("lambda" union) and the final order value.

Survivor rule per order_id: batch before stream (batch is the accurate lane),
then latest event time, then the remaining columns as a total tie-break.
The NULL-key hard gate is a lazy ``raise_error`` inside the plan, so it costs
no extra pass over the data: the first task that meets a NULL key fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import final_order_value
from ..sources import contracts as C
from .dedup import dedup_latest

ORIGIN_BATCH = "batch"
ORIGIN_STREAM = "stream"


UNIFIED_COLUMNS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
                   "year", "month", "order_value", "origin"]


def _origin_rank() -> Column:
    return F.when(F.col("origin") == ORIGIN_BATCH, 0).otherwise(1)


def require_not_null(df: DataFrame, col: str, message: str | None = None) -> DataFrame:
    """Lazy hard gate: fail the job if ``col`` is NULL in any row."""
    msg = message or f"data quality halt: NULL {col}"
    guarded = F.when(F.col(col).isNull(), F.raise_error(F.lit(msg))).otherwise(F.col(col))
    return df.withColumn(col, guarded)


def _stream_side(stream: DataFrame, ts_type) -> DataFrame:
    if "order_purchase_timestamp" not in stream.columns and "event_timestamp" in stream.columns:
        stream = stream.withColumn("order_purchase_timestamp", F.col("event_timestamp").cast(ts_type))
    # The stream's own customer attributes would clash with dimension joins (D3).
    keep = [c for c in stream.columns if c in UNIFIED_COLUMNS]
    return stream.select(*keep).withColumn("origin", F.lit(ORIGIN_STREAM))


def union_candidates(batch: DataFrame, stream: DataFrame | None = None) -> DataFrame:
    """Batch ∪ stream before survivor selection (U1), with ``origin``.

    Checking this for duplicate keys reports overlap between the lanes; the
    same check after ``unify_orders`` would be true by construction."""
    ts_type = batch.schema["order_purchase_timestamp"].dataType
    b = batch.select(*[c for c in batch.columns if c in UNIFIED_COLUMNS]).withColumn("origin", F.lit(ORIGIN_BATCH))
    return b if stream is None else b.unionByName(_stream_side(stream, ts_type), allowMissingColumns=True)


def unify_orders(batch: DataFrame, stream: DataFrame | None = None, gate: bool = True) -> DataFrame:
    """One row per order_id from batch orders and (optionally) stream events."""
    u = union_candidates(batch, stream)
    ts = F.col("order_purchase_timestamp")
    u = u.withColumns({
        "year": F.coalesce(F.col("year"), F.year(ts)) if "year" in u.columns else F.year(ts),
        "month": F.coalesce(F.col("month"), F.month(ts)) if "month" in u.columns else F.month(ts),
        "order_value": F.col("order_value").try_cast(C.MONEY) if "order_value" in u.columns
        else F.lit(None).cast(C.MONEY),
    })
    if gate:
        u = require_not_null(u, "order_id", "data quality halt: NULL order_id in unified orders")
    survivor = [_origin_rank().asc(), ts.desc_nulls_last(), F.col("customer_id").asc_nulls_last(),
                F.col("order_status").asc_nulls_last(), F.col("order_value").desc_nulls_last()]
    return dedup_latest(u, ["order_id"], survivor).select(*UNIFIED_COLUMNS)


def origin_counts(unified: DataFrame) -> DataFrame:
    """Surviving rows per origin: both lanes must contribute (M5)."""
    return unified.groupBy("origin").agg(F.count(F.lit(1)).alias("n_orders"))


def order_values(payments: DataFrame) -> DataFrame:
    """Per order: sum of payment values (A2), decimal."""
    return payments.groupBy("order_id").agg(F.sum("payment_value").cast(C.MONEY).alias("order_value"))


def valued_orders(unified: DataFrame, values: DataFrame) -> DataFrame:
    """Unified orders ⟕ payment sums, with ``final_order_value``.

    Orders that carry the value already (the published lambda table) are taken
    as they are: payments are summed and joined once per run, not per table."""
    if "final_order_value" in unified.columns:
        return unified
    v = values.select("order_id", F.col("order_value").alias("batch_order_value"))
    return unified.join(v, "order_id", "left").withColumn("final_order_value", final_order_value())
