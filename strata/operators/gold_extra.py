"""Gold tables the reference designs but never codes.

The metric definitions are ours (the designs give only names and intent);
each docstring states it. Same conventions as ``gold``: exact decimal sums
published as DOUBLE, averages as exact sum / count, partial aggregation
before every shuffle, windows only over already-aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import band, exact_avg, money_sum
from .gold import current_customers
from .lambda_union import valued_orders


def _person_orders(orders: DataFrame, values: DataFrame, customers: DataFrame) -> DataFrame:
    v = valued_orders(orders, values)
    c = current_customers(customers).select("customer_id", "customer_unique_id", "customer_state")
    return v.join(c, "customer_id")


def customer_frequency(orders: DataFrame, values: DataFrame, customers: DataFrame) -> DataFrame:
    """Per person: orders, active months, average ticket, monetary, monetary per active month."""
    v = _person_orders(orders, values, customers)
    agg = v.groupBy("customer_unique_id").agg(
        F.count("order_id").alias("n_orders"),
        F.count_distinct(F.col("year") * 100 + F.col("month")).alias("active_months"),
        exact_avg("final_order_value").alias("avg_ticket"),
        money_sum("final_order_value").alias("monetary"),
    )
    return agg.withColumn("monetary_per_active_month", F.col("monetary") / F.col("active_months"))


def revenue_by_region(orders: DataFrame, values: DataFrame, customers: DataFrame) -> DataFrame:
    """Per (state, year, month): revenue, orders, and the month's share of the state's year."""
    v = _person_orders(orders, values, customers)
    agg = v.groupBy("customer_state", "year", "month").agg(
        F.sum("final_order_value").alias("__rev"), F.count("order_id").alias("n_orders"))
    year_total = F.sum("__rev").over(Window.partitionBy("customer_state", "year"))
    return agg.select("customer_state", "year", "month", F.col("__rev").cast("double").alias("revenue"), "n_orders",
                      (F.col("__rev").cast("double") / year_total.cast("double")).alias("month_share_of_year"))


def new_vs_returning(orders: DataFrame, values: DataFrame, customers: DataFrame) -> DataFrame:
    """Per (year, month): orders and revenue of first-time vs returning persons.

    A person's first order is the minimum (purchase time, order_id). It is found
    with a grouped ``min`` (partial aggregation, so a person with a huge order
    history costs one row per task in the shuffle) and joined back, instead
    of ranking every order of a person inside one window partition.
    """
    v = _person_orders(orders, values, customers)
    first = v.groupBy("customer_unique_id").agg(
        F.min(F.struct("order_purchase_timestamp", "order_id")).getField("order_id").alias("__first"))
    t = v.join(first, "customer_unique_id").withColumn("__new", F.col("order_id") == F.col("__first"))
    agg = t.groupBy("year", "month").agg(
        F.count_if(F.col("__new")).alias("new_orders"),
        F.count_if(~F.col("__new")).alias("returning_orders"),
        F.sum(F.when(F.col("__new"), F.col("final_order_value"))).alias("__new_rev"),
        F.sum(F.when(~F.col("__new"), F.col("final_order_value"))).alias("__ret_rev"),
        F.sum("final_order_value").alias("__tot"),
    )
    return agg.select(
        "year", "month", "new_orders", "returning_orders",
        F.coalesce(F.col("__new_rev"), F.lit(0)).cast("double").alias("new_revenue"),
        F.coalesce(F.col("__ret_rev"), F.lit(0)).cast("double").alias("returning_revenue"),
        (F.coalesce(F.col("__new_rev"), F.lit(0)).cast("double") / F.col("__tot").cast("double"))
        .alias("new_revenue_share"))


def price_vs_volume(items: DataFrame, products: DataFrame) -> DataFrame:
    """Per category: products, units, average item price, and the correlation
    across products between a product's average price and its units (A14)."""
    p = products.select("product_id", "product_category_name")
    j = items.select("product_id", "price", "quantity").join(p, "product_id")
    per_product = j.groupBy("product_category_name", "product_id").agg(
        F.sum("price").alias("__rev"), F.count("price").alias("__n"), F.sum("quantity").alias("__units"))
    per_product = per_product.withColumn("__avg_price", F.col("__rev").cast("double") / F.col("__n"))
    return per_product.groupBy("product_category_name").agg(
        F.count(F.lit(1)).alias("n_products"),
        F.sum("__units").alias("units"),
        (F.sum("__rev").cast("double") / F.sum("__n")).alias("avg_price"),
        F.round(F.corr("__avg_price", F.col("__units").cast("double")), 6).alias("price_volume_corr"),
    )


def payment_performance(payments: DataFrame) -> DataFrame:
    """Per payment type: revenue, transactions, average ticket, average
    installments and share of all revenue (A15). The share's window runs over
    one row per payment type."""
    agg = payments.groupBy("payment_type").agg(
        F.sum("payment_value").alias("__rev"),
        F.count(F.lit(1)).alias("transactions"),
        (F.sum("payment_installments").cast("double") / F.count("payment_installments")).alias("avg_installments"),
    )
    total = F.sum("__rev").over(Window.partitionBy())
    return agg.select(
        "payment_type", F.col("__rev").cast("double").alias("revenue"), "transactions",
        (F.col("__rev").cast("double") / F.col("transactions")).alias("avg_ticket"), "avg_installments",
        (F.col("__rev").cast("double") / total.cast("double")).alias("revenue_share"))


def product_profitability(items: DataFrame, products: DataFrame) -> DataFrame:
    """Per product: revenue, freight, revenue net of freight and its ratio.

    The schema has no cost column, so "profit" is the proxy Σ(price − freight)."""
    p = products.select("product_id", "product_category_name")
    agg = items.groupBy("product_id").agg(
        F.sum("price").alias("__rev"), F.sum("freight_value").alias("__fr"), F.sum("quantity").alias("units"))
    return agg.join(p, "product_id", "left").select(
        "product_id", "product_category_name", "units",
        F.col("__rev").cast("double").alias("revenue"), F.col("__fr").cast("double").alias("freight"),
        (F.col("__rev") - F.col("__fr")).cast("double").alias("net_of_freight"),
        ((F.col("__rev") - F.col("__fr")).cast("double") / F.col("__rev").cast("double")).alias("net_ratio"))


# Temperature bands of the weather-impact table.
BAND_COOL_BELOW = 45.0
BAND_MILD_BELOW = 55.0


NO_WEATHER = "unknown"  # orders whose hour has no reading


def weather_band(col: str) -> F.Column:
    return band(col, [(BAND_COOL_BELOW, "cool"), (BAND_MILD_BELOW, "mild")], "warm")


def calendar_hour_profile(weather: DataFrame) -> DataFrame:
    """Hourly weather folded onto calendar hours (month, day, hour): the
    reading-weighted mean, so it equals the mean of all raw readings of that
    calendar hour. At most 366 × 24 rows whatever the data volume."""
    return weather.groupBy(F.month("obs_hour").alias("__m"), F.dayofmonth("obs_hour").alias("__d"),
                           F.hour("obs_hour").alias("__h")).agg(
        (F.sum(F.col("temperature") * F.col("readings")) / F.sum("readings")).alias("temperature"))


def weather_impact(orders: DataFrame, values: DataFrame, weather: DataFrame) -> DataFrame:
    """Per (year, month, band): orders and revenue under each weather band.

    J13: orders meet the weather of their calendar hour (month, day, hour),
    because the fixture's order and weather years do not overlap; orders of
    an hour without readings stay, as "unknown". The
    calendar profile has a fixed upper bound of 8,784 rows, so it is
    broadcast: the order side is never shuffled for this join, which also
    keeps it safe when orders pile up on a few hours (e.g. all at midnight).
    """
    v = valued_orders(orders, values)
    ts = F.col("order_purchase_timestamp")
    o = v.select("order_id", "year", "month", "final_order_value",
                 F.month(ts).alias("__m"), F.dayofmonth(ts).alias("__d"), F.hour(ts).alias("__h"))
    w = calendar_hour_profile(weather).select("__m", "__d", "__h",
                                              weather_band("temperature").alias("condition_band"))
    j = o.join(F.broadcast(w), ["__m", "__d", "__h"], "left") \
        .withColumn("condition_band", F.coalesce("condition_band", F.lit(NO_WEATHER)))
    return j.groupBy("year", "month", "condition_band").agg(
        F.count("order_id").alias("n_orders"), money_sum("final_order_value").alias("revenue"))


def sales_obt(orders: DataFrame, values: DataFrame, items: DataFrame, products: DataFrame,
              customers: DataFrame) -> DataFrame:
    """One row per unified order (A19): order facts, customer place, item count,
    item revenue, top category by revenue (ties: smallest name), final value."""
    p = products.select("product_id", "product_category_name")
    ic = items.select("order_id", "product_id", "price").join(p, "product_id", "left") \
        .groupBy("order_id", "product_category_name").agg(F.sum("price").alias("__cat_rev"),
                                                          F.count(F.lit(1)).alias("__n"))
    per_order = ic.groupBy("order_id").agg(
        F.sum("__n").alias("n_items"),
        F.sum("__cat_rev").cast("double").alias("items_revenue"),
        F.min(F.struct((-F.col("__cat_rev")).alias("neg_rev"),
                       F.col("product_category_name").alias("cat"))).getField("cat").alias("top_category"))
    c = current_customers(customers).select("customer_id", "customer_state", "customer_city")
    v = valued_orders(orders, values)
    return v.join(per_order, "order_id", "left").join(c, "customer_id", "left").select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "year", "month", "origin",
        "customer_state", "customer_city", F.coalesce(F.col("n_items"), F.lit(0)).alias("n_items"),
        F.coalesce(F.col("items_revenue"), F.lit(0.0)).alias("items_revenue"), "top_category",
        F.col("final_order_value").cast("double").alias("final_order_value"))
