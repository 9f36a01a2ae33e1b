"""Raw domain tables derived from the driver's parquet tables.

The driver ships TPC-H-like tables; this module maps them onto the
e-commerce domain (orders, items, payments, products, sellers, customers,
geolocation, reviews, stream events). Every function is lazy and reads the
whole table; column selection happens here, so the scan's ReadSchema only
carries what the domain view uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import settled
from . import contracts as C


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money(c) -> F.Column:
    """Source double → decimal(18,2). ``try_cast``: a value that does not fit
    becomes NULL (reported by the not-null rules) instead of failing the job."""
    return F.col(c).try_cast(C.MONEY) if isinstance(c, str) else c.try_cast(C.MONEY)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("o_orderpriority").alias("order_priority"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    price = _money("l_extendedprice")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        F.round(price * _money("l_tax"), 2).try_cast(C.MONEY).alias("freight_value"),
        F.col("l_quantity").try_cast("int").alias("quantity"),
        F.col("l_discount").try_cast("decimal(4,2)").alias("discount"),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        F.col("l_quantity").try_cast("int").alias("payment_installments"),
        _money("l_extendedprice").alias("payment_value"),
        F.col("l_shipdate").alias("paid_at"),
        # tie-break columns carried for a total dedup order
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("product_brand"),
        F.col("p_type").alias("product_category_name"),
        F.col("p_size").alias("product_size"),
        _money("p_retailprice").alias("list_price"),
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_name").alias("seller_name"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_state"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_unique_id = floor(c_custkey / 3): one person owns several ids."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    return c.join(geo, c.c_nationkey == geo.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.floor(F.col("c_custkey") / 3).cast("bigint").alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("r_name").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
        F.col("c_mktsegment").alias("customer_segment"),
    )


# Fixed values of the second customer delivery (SCD2 input): which segment
# moves, and the offset that turns a key into a new one.
MOVING_SEGMENT = "MACHINERY"
NEW_KEY_OFFSET = 1_000_000_000


def customer_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second delivery of customers for the SCD2 merge.

    * customers with a negative balance are absent from it (untouched keys);
    * customers of the moving segment changed state (next nation, modulo 25);
    * customers with a negative balance also come back under a new key.
    Everything else arrives unchanged.
    """
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    moved_nation = F.when(F.col("c_mktsegment") == MOVING_SEGMENT, (F.col("c_nationkey") + 1) % 25) \
        .otherwise(F.col("c_nationkey")).cast("int")
    present = c.filter(F.col("c_acctbal") >= 0).withColumn("nk", moved_nation) \
        .withColumn("cid", F.col("c_custkey"))
    new_keys = c.filter(F.col("c_acctbal") < 0).withColumn("nk", F.col("c_nationkey")) \
        .withColumn("cid", F.col("c_custkey") + F.lit(NEW_KEY_OFFSET))
    both = present.unionByName(new_keys)
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    return both.join(geo, both.nk == geo.n_nationkey, "left").select(
        F.col("cid").alias("customer_id"),
        F.floor(F.col("cid") / 3).cast("bigint").alias("customer_unique_id"),
        F.col("nk").alias("customer_zip_code_prefix"),
        F.col("r_name").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
        F.col("c_mktsegment").alias("customer_segment"),
    )


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zip prefix = nation key (heavily repeated), lat = balance; source_row_id breaks ties."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    return c.join(geo, c.c_nationkey == geo.n_nationkey, "left").select(
        F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
        F.col("c_acctbal").alias("geolocation_lat"),
        (F.col("c_acctbal") / 100.0).alias("geolocation_lng"),
        F.col("r_name").alias("geolocation_city"),
        F.col("n_name").alias("geolocation_state"),
        F.col("c_custkey").alias("source_row_id"),
    )


# Category translation rows. PROMO is left out on purpose so
# the "otros" fallback is exercised.
CATEGORY_TRANSLATION = [
    ("ECONOMY", "economy"),
    ("LARGE", "large_items"),
    ("MEDIUM", "medium_items"),
    ("SMALL", "small_items"),
    ("STANDARD", "standard"),
]
UNKNOWN_CATEGORY = "otros"


def category_translation(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORY_TRANSLATION, schema=C.TRANSLATION)


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels ⟕ documents: score 1 + 4*quality, message NULL for toxic rows."""
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    j = lab.join(docs, "doc_id", "left")
    return j.select(
        F.col("doc_id").alias("review_id"),
        F.col("doc_id").alias("order_id"),
        (F.lit(1) + F.lit(4) * F.col("quality")).cast("int").alias("review_score"),
        F.when((F.col("toxic") == 0) & (F.col("quality") == 1), F.col("source")).alias("review_comment_title"),
        F.when(F.col("toxic") == 0, F.col("text")).alias("review_comment_message"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream events as the speed layer receives them (typed).

    order_id = event_id + count(events): the upper half of the ids overlaps
    batch order keys. The count is one small job (Parquet answers it from
    row-group metadata) and enters the plan as a literal, so it is not
    re-planned inside every expression that uses order_id.
    """
    ev = table(spark, sf_dir, "events")
    n_events = ev.count()
    return ev.select(
        (F.col("event_id") + F.lit(n_events)).alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("order_status"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.col("value").alias("order_value"),
        F.col("event_id"),
    )


# Microsecond ISO timestamps in payloads (the default keeps only millis).
EVENT_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON payloads as a Kafka topic would carry them (column ``value``).

    Invalid payloads are derived from the data: ``error`` events lack the
    order_value key; events worth less than 1.0 are cut to half their text.
    """
    ev = raw_events(spark, sf_dir)
    opts = {"timestampFormat": EVENT_TS_FORMAT}
    full = F.to_json(F.struct("order_id", "customer_id", "order_status", "event_timestamp", "order_value"), opts)
    missing = F.to_json(F.struct("order_id", "customer_id", "order_status", "event_timestamp"), opts)
    payload = (
        F.when(F.col("order_status") == "error", missing)
        .when(F.col("order_value") < 1.0, F.substring(full, 1, (F.length(full) / 2).cast("int")))
        .otherwise(full)
    )
    return ev.select(F.col("event_id"), settled(payload).alias("value"), F.col("event_timestamp"))


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly measurement: mean event value per hour (the weather stand-in).

    The mean is the exact decimal sum over the count, so it does not depend
    on the order in which partial sums are combined."""
    ev = table(spark, sf_dir, "events")
    return (
        ev.groupBy(F.date_trunc("hour", F.col("ts")).alias("obs_hour"))
        .agg((F.sum(F.col("value").cast(C.MONEY)).cast("double") / F.count(F.lit(1))).alias("temperature"),
             F.count(F.lit(1)).alias("readings"))
    )
