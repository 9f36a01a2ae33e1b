"""A key holding a third of all rows: AQE splits its join partition, and the
repository's operators keep hot groups out of single tasks."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from strata.operators import gold_extra as GX
from strata.operators import lambda_union as LU


@contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


SKEW = {"spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
        "spark.sql.shuffle.partitions": "16"}


def _hot(spark, n=600_000):
    # a third of the rows share order 7; sha2 keeps the payload incompressible
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("order_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def test_aqe_splits_hot_join_partition(spark):
    with conf(spark, **SKEW):
        items = _hot(spark)
        orders = spark.range(0, 600_000, 1, 8).select(F.col("id").alias("order_id"),
                                                       (F.col("id") % 5).alias("status"))
        df = items.join(orders, "order_id").groupBy("status").agg(F.count("pad").alias("n"))
        got = {r.status: r.n for r in df.collect()}
        final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in final and "AQEShuffleRead skewed" in final
    assert sum(got.values()) == 600_000


def test_hot_person_in_point_in_time_style_join(spark):
    """The left-hand (fact) side is the skewed one in every fact ⋈ dimension join."""
    import datetime as dt
    with conf(spark, **SKEW):
        facts = _hot(spark, 300_000).select(F.col("order_id").alias("customer_id"), "pad")
        dim = spark.range(0, 300_000, 1, 4).select(F.col("id").alias("customer_id"),
                                                    F.lit("S").alias("customer_state"),
                                                    F.lit(dt.date(2020, 1, 1)).alias("effective_date"),
                                                    F.lit(dt.date(9999, 12, 31)).alias("end_date"))
        from strata.operators.scd2 import point_in_time_join
        out = point_in_time_join(facts.withColumn("ts", F.lit(dt.datetime(2024, 1, 1))), dim, "customer_id",
                                 "ts", ["customer_state"])
        n = out.filter(F.col("customer_state") == "S").count()
    assert n == 300_000


def test_unify_orders_hot_key(spark):
    """Many copies of one order_id in the union keep one survivor."""
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    b = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("order_id"),
        F.col("id").alias("customer_id"), F.lit("F").alias("order_status"),
        (F.lit(t).cast("timestamp_ntz") + F.make_interval(secs=F.col("id"))).alias("order_purchase_timestamp"),
        F.lit(2024).alias("year"), F.lit(1).alias("month"))
    u = LU.unify_orders(b)
    assert u.count() == 60_000  # ids ≡ 0 (mod 3) and id 7 itself all become order 7
    hot = u.filter("order_id = 7").first()
    assert hot.customer_id == 89_997  # latest purchase time wins
    values = spark.createDataFrame([], "order_id long, order_value decimal(18,2)")
    cust = b.select("customer_id", F.lit(1).cast("long").alias("customer_unique_id"), F.lit("S").alias("customer_state"))
    nv = GX.new_vs_returning(u, values, cust).agg(F.sum("new_orders")).first()[0]
    assert nv == 1
