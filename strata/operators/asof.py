"""As-of join: the nearest earlier row of another table, within a tolerance.

Both tables are dealt into time buckets and, within a bucket, into slots: a
bucket has one slot per ``rows_per_slot`` left rows, so an hour that holds a
third of all rows is spread over as many tasks as it needs. A right row goes to all
slots of its own bucket and of those that the tolerance reaches. In a slot the two
sides are one sorted union, and the last right row before each left row is a
running ``last(ignore nulls)``. Nothing is compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, columns: Sequence[str], tolerance_seconds: int,
              bucket_seconds: int = 86_400, rows_per_slot: int = 1_000_000) -> DataFrame:
    """``left`` with ``columns`` of the latest right row at or before its time, at most ``tolerance_seconds`` earlier.

    Every left row stays, once; without such a right row, with a NULL time, or
    over an empty right table, ``columns`` are NULL. Of right rows at the same
    time the one with the greatest ``columns`` counts; right rows without a
    time don't. Times are compared to the microsecond.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    bucket = lambda t: F.floor(F.unix_seconds(F.timestamp_micros(t)) / bucket_seconds)
    own = left.columns
    rows = left.select(F.struct(*own).alias("__l"), micros(left_ts).alias("__t")).withColumn("__b", bucket(F.col("__t")))
    readings = right.where(F.col(right_ts).isNotNull()).select(micros(right_ts).alias("__t"), F.struct(*columns).alias("__r")) \
        .groupBy("__t").agg(F.max("__r").alias("__r"))
    slots = rows.where(F.col("__b").isNotNull()).groupBy("__b").agg(F.ceil(F.count(F.lit(1)) / rows_per_slot).alias("__slots"))
    reach = F.explode(F.sequence(bucket(F.col("__t")), bucket(F.col("__t") + tolerance_seconds * 1_000_000)))
    dealt = readings.select("__t", "__r", reach.alias("__b")).join(slots, "__b") \
        .select("__b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__slots") - 1)).alias("__s"), "__t", F.lit(0).alias("__side"),
                F.struct(F.col("__t").alias("at"), F.col("__r").alias("of")).alias("__r"), F.lit(None).cast(rows.schema["__l"].dataType).alias("__l"))
    kind = dealt.schema["__r"].dataType
    asked = rows.join(slots, "__b", "left").select(
        "__b", F.coalesce(F.pmod(F.xxhash64("__l"), F.col("__slots")), F.lit(0)).cast("long").alias("__s"), "__t", F.lit(1).alias("__side"),
        F.lit(None).cast(kind).alias("__r"), "__l")
    before = Window.partitionBy("__b", "__s").orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    met = dealt.unionByName(asked).withColumn("__r", F.last("__r", ignorenulls=True).over(before)).where("__side = 1")
    near = F.col("__t") - F.col("__r.at") <= tolerance_seconds * 1_000_000
    return met.select("__l.*", *[F.when(near, F.col("__r.of").getField(c)).alias(c) for c in columns])
