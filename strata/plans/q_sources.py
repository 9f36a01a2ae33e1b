"""Registered query over raw tables bound by contract (S1): text ids, own column names, change times."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import testdata as D
from ..sources.binding import Binding, BoundTables
from . import oracle as O
from .registry import AS_OF, query

BAD_PRICE_EACH = 50   # fixed value: of every so many orders, the first item's price is no number
STALE_EACH = 7        # fixed value: of every so many orders, an older version is delivered too
LATE_AFTER_DAYS = 10  # fixed value: estimated delivery


def _days(ts: str, n) -> F.Column:
    return F.col(ts) + F.make_dt_interval(days=n if not isinstance(n, int) else F.lit(n))


def text_keyed_tables(spark: SparkSession, sf_dir: str, root: str) -> BoundTables:
    """The driver's tables as a shop's own raw delivery: eight Parquet folders with ids as text.

    Orders carry approval, delivery and change times, and every ``STALE_EACH``th
    an older version; item prices are text, some of them no number; the
    products' name length is never filled; payments name their columns otherwise.
    """
    def text_id(prefix: str, col: str) -> F.Column:
        return F.concat(F.lit(prefix), F.col(col).cast("string"))

    key, bought = F.col("order_id"), "order_purchase_timestamp"
    orders = D.raw_orders(spark, sf_dir).select(
        text_id("o", "order_id").alias("order_id"), text_id("c", "customer_id").alias("customer_id"), "order_status", bought,
        (F.col(bought) + F.expr("INTERVAL 1 HOUR")).alias("order_approved_at"), _days(bought, 2).alias("order_delivered_carrier_date"),
        F.when(F.col("order_status") == "F", _days(bought, (key % 20).cast("int"))).alias("order_delivered_customer_date"),
        _days(bought, LATE_AFTER_DAYS).alias("order_estimated_delivery_date"), _days(bought, 30).alias("updated_at"),
        (key % STALE_EACH == 0).alias("stale"))
    none = F.lit(None).cast("timestamp_ntz")
    older = orders.where("stale").withColumns({
        "order_status": F.lit("created"), "order_delivered_customer_date": none, "updated_at": F.col(bought)})
    items = D.raw_order_items(spark, sf_dir).select(
        text_id("o", "order_id").alias("order_id"), "order_item_id", text_id("p", "product_id").alias("product_id"),
        text_id("s", "seller_id").alias("seller_id"), "shipping_limit_date",
        F.when((key % BAD_PRICE_EACH == 0) & (F.col("order_item_id") == 1), F.lit("n/a")).otherwise(F.col("price").cast("string")).alias("price"),
        "freight_value")
    payments = D.raw_payments(spark, sf_dir).select(
        text_id("o", "order_id").alias("order"), F.col("payment_sequential").alias("seq"), "payment_type",
        F.col("payment_installments").alias("installments"), F.col("payment_value").cast("double").alias("amount"),
        F.col("paid_at").alias("updated_at"))
    none_int = F.lit(None).cast("int")
    tables = {
        "orders": orders.unionByName(older).drop("stale"),
        "order_items": items,
        "payments": payments,
        "products": D.raw_products(spark, sf_dir).select(
            text_id("p", "product_id").alias("product_id"), "product_category_name", none_int.alias("product_name_length"),
            (F.col("product_size") * 100).alias("product_weight_g")),
        "sellers": D.raw_sellers(spark, sf_dir).select(
            text_id("s", "seller_id").alias("seller_id"), F.lpad(F.col("seller_zip_code_prefix").cast("string"), 5, "0").alias("seller_zip_code_prefix"),
            F.col("seller_state"), F.lower("seller_state").alias("seller_city")),
        "customers": D.raw_customers(spark, sf_dir).select(
            text_id("c", "customer_id").alias("customer_id"), text_id("u", "customer_unique_id").alias("customer_unique_id"),
            F.lpad(F.col("customer_zip_code_prefix").cast("string"), 5, "0").alias("customer_zip_code_prefix"), "customer_city", "customer_state"),
        "geolocation": D.raw_geolocation(spark, sf_dir).select(
            F.lpad(F.col("geolocation_zip_code_prefix").cast("string"), 5, "0").alias("geolocation_zip_code_prefix"), "geolocation_lat",
            "geolocation_lng", "geolocation_city", "geolocation_state"),
        "reviews": D.raw_reviews(spark, sf_dir).select(
            text_id("r", "review_id").alias("review_id"), text_id("o", "order_id").alias("order_id"), "review_score", "review_comment_title",
            "review_comment_message"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}")
    bound = {name: Binding(f"{root}/{name}") for name in tables}
    bound["payments"] = Binding(f"{root}/payments", {"order_id": "order", "payment_sequential": "seq", "payment_installments": "installments",
                                                     "payment_value": "amount"})
    bound["order_items"] = Binding(f"{root}/order_items", defaults={"quantity": 1, "discount": 0})
    return BoundTables(bound)


@query("bound_delivery_times", O.sql(f"""
    WITH o AS (SELECT order_id, year, month, order_purchase_timestamp AS bought,
                      CASE WHEN order_status = 'F' THEN order_purchase_timestamp + to_days(CAST(order_id % 20 AS INTEGER)) END AS delivered
               FROM s_orders),
    i AS (SELECT order_id, CASE WHEN order_id % {BAD_PRICE_EACH} = 0 AND order_item_id = 1 THEN NULL ELSE price END AS price FROM raw_items
          QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, order_item_id ORDER BY shipping_limit_date DESC NULLS LAST,
                   'p' || product_id, 's' || seller_id, price DESC NULLS LAST) = 1),  -- ids are ordered as text here
    per AS (SELECT order_id, count(*) AS n_items, count(price) AS n_priced, SUM(price) AS revenue FROM i GROUP BY order_id)
    SELECT o.year, o.month, count(*) AS n_orders, count(delivered) AS n_delivered,
           count(CASE WHEN delivered > bought + to_days({LATE_AFTER_DAYS}) THEN 1 END) AS n_late,
           CAST(SUM(date_diff('day', bought, delivered)) AS BIGINT) AS delivery_days,
           CAST(COALESCE(SUM(n_items), 0) AS BIGINT) AS n_items, CAST(COALESCE(SUM(n_priced), 0) AS BIGINT) AS n_priced,
           CAST(SUM(revenue) AS DOUBLE) AS revenue
    FROM o LEFT JOIN per ON o.order_id = per.order_id GROUP BY o.year, o.month""", "s_orders", "raw_items"))
def q_bound_delivery_times(spark, sf) -> DataFrame:
    """Delivery times and revenue per month from raw tables with text ids, bound by contract and taken to silver.

    Writes the raw folders and runs the raw-to-silver stage when called, under
    the shared checkpoint folder."""
    from . import pipeline as P
    root = scratch_path(spark, "bound", uuid.uuid4().hex)
    cfg = P.PipelineConfig("", f"{root}/lake", AS_OF, sources=text_keyed_tables(spark, sf, f"{root}/raw"))
    P.run(spark, cfg, ["raw_to_silver"])
    orders = spark.read.parquet(cfg.p("silver", "fact_orders"))
    items = spark.read.parquet(cfg.p("silver", "fact_order_items")).drop("year", "month")
    per = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"), F.count("price").alias("n_priced"), F.sum("price").alias("revenue"))
    took = F.datediff("order_delivered_customer_date", "order_purchase_timestamp")
    late = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    return orders.join(per, "order_id", "left").groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count("order_delivered_customer_date").alias("n_delivered"), F.count_if(late).alias("n_late"),
        F.sum(took).alias("delivery_days"), F.coalesce(F.sum("n_items"), F.lit(0)).alias("n_items"),
        F.coalesce(F.sum("n_priced"), F.lit(0)).alias("n_priced"), F.sum("revenue").cast("double").alias("revenue"))
