"""Gold aggregates over silver and the unified order table.

Sums are exact (decimal) and published as DOUBLE, like the reference's gold
tables; an average is that exact sum divided by the count, so it does not
depend on summation order. Every aggregate is a hash aggregate with a partial
(map-side) phase, so a hot grouping key is pre-combined before the shuffle.
Joins carry pruned dimension sides; the planner broadcasts a side only when
its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (and AQE
re-checks at run time), otherwise it shuffles, splitting skewed partitions.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import exact_avg, money_sum
from .lambda_union import valued_orders


def current_customers(dim: DataFrame) -> DataFrame:
    """Current version of an SCD2 dimension; a plain table passes through."""
    return dim.filter(F.col("is_current")) if "is_current" in dim.columns else dim


def sales_by_category(items: DataFrame, products: DataFrame, orders: DataFrame,
                      translation: DataFrame | None = None) -> DataFrame:
    """(category, year, month): total_revenue = Σ price, total_items_sold (A3).

    NULL category is its own group. With ``translation`` the English name is
    added (fallback "otros"), which is what the category view serves (V2).
    """
    p = products.select("product_id", "product_category_name")
    o = orders.select("order_id", "year", "month")
    j = items.select("order_id", "order_item_id", "product_id", "price") \
        .join(p, "product_id").join(o, "order_id")
    keys = ["product_category_name", "year", "month"]
    out = j.groupBy(*keys).agg(
        money_sum("price").alias("total_revenue"),
        F.count("order_item_id").alias("total_items_sold"),
    )
    if translation is not None:
        from .silver import translate_categories
        out = translate_categories(out, translation)
    return out


def sales_by_region(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """(customer_state, year, month): total_orders (A4).

    The order side's own customer attributes are dropped first, so a stream
    row carrying ``customer_state`` cannot make the reference ambiguous (D3).
    """
    c = current_customers(customers).select("customer_id", "customer_state")
    o = orders.select("order_id", "customer_id", "year", "month")
    return o.join(c, "customer_id").groupBy("customer_state", "year", "month") \
        .agg(F.count("order_id").alias("total_orders"))


def sales_by_payment(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """(payment_type, year, month): revenue and payment-row count (A5)."""
    o = orders.select("order_id", "year", "month")
    p = payments.select("order_id", "payment_type", "payment_value")
    return p.join(o, "order_id").groupBy("payment_type", "year", "month").agg(
        money_sum("payment_value").alias("total_revenue"),
        F.count("order_id").alias("total_transactions"),
    )


def customer_segmentation(orders: DataFrame, customers: DataFrame, values: DataFrame,
                          as_of: date | str) -> DataFrame:
    """RFM per person (customer_unique_id): recency as of ``as_of``."""
    v = valued_orders(orders, values).select("order_id", "customer_id", "order_purchase_timestamp",
                                             "final_order_value")
    c = current_customers(customers).select("customer_id", "customer_unique_id")
    agg = v.join(c, "customer_id").groupBy("customer_unique_id").agg(
        F.max("order_purchase_timestamp").alias("last_purchase_date"),
        F.count("order_id").alias("frequency"),
        money_sum("final_order_value").alias("monetary"),
    )
    return agg.withColumn("recency_days", F.datediff(F.lit(as_of).cast("date"), F.col("last_purchase_date")))


def order_value_metrics(orders: DataFrame, values: DataFrame) -> DataFrame:
    """(year, month): ticket avg/max/min and orders; unpaid orders count as 0."""
    own = [c for c in ("final_order_value",) if c in orders.columns]  # the published table carries it already
    v = valued_orders(orders.select("order_id", "year", "month", "order_value", *own), values)
    return v.groupBy("year", "month").agg(
        exact_avg("final_order_value").alias("average_ticket"),
        F.max("final_order_value").cast("double").alias("max_ticket"),
        F.min("final_order_value").cast("double").alias("min_ticket"),
        F.count("order_id").alias("total_orders"),
    )
