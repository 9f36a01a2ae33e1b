"""Registered queries: name → (Spark query, oracle SQL or None).

Each Spark query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the whole tables. Published outputs carry money as DOUBLE (converted once
from the exact decimal value), and every computed column is aliased to the
same name as in its oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import gold as G
from ..operators import lambda_union as LU
from ..operators import silver as S
from . import oracle as O
from .layers import Layers

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

# Fixed evaluation date of every "as of" query (recency, SCD2 dates).
AS_OF = "2024-02-01"


def query(name: str, oracle: str | None):
    """Register ``fn`` under ``name``; its result is published through ``publish``."""
    def deco(fn: QueryFn) -> QueryFn:
        def published(spark: SparkSession, sf_dir: str) -> DataFrame:
            return publish(fn(spark, sf_dir))
        published.__name__ = fn.__name__
        published.__doc__ = fn.__doc__
        REGISTRY[name] = (published, oracle)
        return fn
    return deco


def publish(df: DataFrame) -> DataFrame:
    """Published column types: decimal → DOUBLE, session-zone timestamp → TIMESTAMP_NTZ.

    The NTZ value is the wall-clock time in the session zone, which is the
    time the data was read and computed in, so the published result is the
    same whatever zone the reading session uses."""
    def conv(f):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        return F.col(f.name)
    if not any(isinstance(f.dataType, (T.DecimalType, T.TimestampType)) for f in df.schema.fields):
        return df
    return df.select(*[conv(f) for f in df.schema.fields])


# ---------------------------------------------------------------- silver

@query("silver_order_items_dedup", O.sql("""
    SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
           CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value, quantity,
           CAST(discount AS DOUBLE) AS discount
    FROM s_items""", "s_items"))
def q_items_dedup(spark, sf):
    return publish(Layers(spark, sf).items)


@query("silver_geolocation_dedup", O.sql("SELECT * FROM s_geo", "s_geo"))
def q_geo_dedup(spark, sf):
    return Layers(spark, sf).geolocation


@query("silver_customers_dedup", O.sql("SELECT * FROM s_customers", "s_customers"))
def q_customers_dedup(spark, sf):
    return Layers(spark, sf).customers


@query("sellers_geo", O.sql("""
    SELECT s.seller_zip_code_prefix, s.seller_id, s.seller_name, s.seller_state, g.geolocation_lat, g.geolocation_lng
    FROM s_sellers s LEFT JOIN s_geo g ON s.seller_zip_code_prefix = g.geolocation_zip_code_prefix""", "s_sellers", "s_geo"))
def q_sellers_geo(spark, sf):
    L = Layers(spark, sf)
    return S.sellers_with_geo(L.sellers, L.geolocation)


@query("products_without_null_columns", O.sql("""
    SELECT product_id, product_name, product_brand, product_category_name, product_size,
           CAST(list_price AS DOUBLE) AS list_price FROM s_products""", "s_products"))
def q_products_without_null_columns(spark, sf):
    """Name and description length are never filled in the shop's products; one pass finds and drops them."""
    none = F.lit(None).cast("int")
    delivered = Layers(spark, sf).products.withColumns({"product_name_length": none, "product_description_length": none})
    return publish(S.drop_null_columns(delivered))


@query("silver_orders_partition_cols", O.sql("SELECT * FROM s_orders", "s_orders"))
def q_orders_partition_cols(spark, sf):
    return Layers(spark, sf).orders


@query("silver_reviews_filled", O.sql("SELECT * FROM s_reviews", "s_reviews"))
def q_reviews_filled(spark, sf):
    return Layers(spark, sf).reviews


@query("silver_delivered_only", O.sql("SELECT * FROM s_orders WHERE order_status = 'F'", "s_orders"))
def q_delivered_only(spark, sf):
    # In the fixture, status F (fulfilled) plays the part of "delivered".
    return S.delivered_only(Layers(spark, sf).orders, delivered="F")


@query("silver_payments_dedup", O.sql("""
    SELECT order_id, payment_sequential, payment_type, payment_installments,
           CAST(payment_value AS DOUBLE) AS payment_value, paid_at
    FROM s_payments""", "s_payments"))
def q_payments_dedup(spark, sf):
    return publish(Layers(spark, sf).payments)


@query("items_enriched_left", O.sql("""
    SELECT i.seller_id, i.product_id, i.order_id, i.order_item_id, i.shipping_limit_date,
           CAST(i.price AS DOUBLE) AS price, CAST(i.freight_value AS DOUBLE) AS freight_value, i.quantity,
           CAST(i.discount AS DOUBLE) AS discount, p.product_category_name, s.seller_state
    FROM s_items i LEFT JOIN s_products p ON i.product_id = p.product_id
    LEFT JOIN s_sellers s ON i.seller_id = s.seller_id""", "s_items", "s_products", "s_sellers"))
def q_items_enriched(spark, sf):
    L = Layers(spark, sf)
    return publish(S.enrich_items(L.items, L.products, L.sellers))


@query("products_translated", O.sql(f"""
    SELECT p.product_category_name, p.product_id, p.product_name, p.product_brand, p.product_size,
           CAST(p.list_price AS DOUBLE) AS list_price,
           COALESCE(t.product_category_name_english, 'otros') AS product_category_name_english
    FROM s_products p LEFT JOIN translation t ON p.product_category_name = t.product_category_name""",
                                    "s_products", "translation"))
def q_products_translated(spark, sf):
    L = Layers(spark, sf)
    return publish(S.translate_categories(L.products, L.translation))


@query("customers_geo", O.sql("""
    SELECT c.*, g.geolocation_lat, g.geolocation_lng
    FROM s_customers c LEFT JOIN s_geo g ON c.customer_zip_code_prefix = g.geolocation_zip_code_prefix""",
                              "s_customers", "s_geo"))
def q_customers_geo(spark, sf):
    L = Layers(spark, sf)
    return S.customers_with_geo(L.customers, L.geolocation)


@query("silver_sellers_dedup", O.sql("SELECT * FROM s_sellers", "s_sellers"))
def q_sellers_dedup(spark, sf):
    return Layers(spark, sf).sellers


@query("silver_products_dedup", O.sql("SELECT * FROM s_products", "s_products"))
def q_products_dedup(spark, sf):
    return Layers(spark, sf).products


@query("silver_reviews_single_key", O.sql("""
    SELECT review_id, order_id, review_score,
           COALESCE(review_comment_title, '') AS review_comment_title,
           COALESCE(review_comment_message, 'sin_comentario') AS review_comment_message
    FROM raw_reviews
    QUALIFY ROW_NUMBER() OVER (PARTITION BY review_id ORDER BY order_id ASC NULLS LAST,
             review_score DESC NULLS LAST) = 1""", "raw_reviews"))
def q_reviews_single_key(spark, sf):
    """The reference keys reviews by review_id alone (D5); kept as an option."""
    from ..sources import testdata as D
    return S.clean_reviews(D.raw_reviews(spark, sf), single_key=True)


@query("items_order_partition", O.sql("""
    SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date,
           CAST(i.price AS DOUBLE) AS price, CAST(i.freight_value AS DOUBLE) AS freight_value, i.quantity,
           CAST(i.discount AS DOUBLE) AS discount, o.year, o.month
    FROM s_items i LEFT JOIN s_orders o ON i.order_id = o.order_id""", "s_items", "s_orders"))
def q_items_order_partition(spark, sf):
    """Items carrying their order's year/month, the layout key of the items table."""
    L = Layers(spark, sf)
    return S.items_with_order_partition(L.items, L.orders)


# ---------------------------------------------------------------- lambda

@query("order_values", O.sql("SELECT order_id, CAST(order_value AS DOUBLE) AS order_value FROM order_values",
                             "order_values"))
def q_order_values(spark, sf):
    return publish(Layers(spark, sf).order_values)


@query("lambda_orders", O.sql("""
    SELECT order_id, customer_id, order_status, order_purchase_timestamp, year, month,
           CAST(order_value AS DOUBLE) AS order_value, origin FROM unified""", "unified"))
def q_lambda_orders(spark, sf):
    return publish(Layers(spark, sf).unified_orders)


@query("lambda_origin_counts", O.sql("SELECT origin, COUNT(*) AS n_orders FROM unified GROUP BY origin",
                                     "unified"))
def q_lambda_origin_counts(spark, sf):
    return LU.origin_counts(Layers(spark, sf).unified_orders)


@query("final_order_value", O.sql("""
    SELECT order_id, origin, CAST(batch_order_value AS DOUBLE) AS batch_order_value,
           CAST(order_value AS DOUBLE) AS order_value, CAST(final_order_value AS DOUBLE) AS final_order_value
    FROM valued""", "valued"))
def q_final_order_value(spark, sf):
    L = Layers(spark, sf)
    v = LU.valued_orders(L.unified_orders, L.order_values)
    return publish(v.select("order_id", "origin", "batch_order_value", "order_value", "final_order_value"))


# ---------------------------------------------------------------- gold

@query("gold_sales_by_category", O.sql("""
    SELECT p.product_category_name, o.year, o.month, CAST(SUM(i.price) AS DOUBLE) AS total_revenue,
           COUNT(i.order_item_id) AS total_items_sold
    FROM s_items i JOIN s_products p ON i.product_id = p.product_id
    JOIN unified o ON i.order_id = o.order_id
    GROUP BY p.product_category_name, o.year, o.month""", "s_items", "s_products", "unified"))
def q_sales_by_category(spark, sf):
    L = Layers(spark, sf)
    return G.sales_by_category(L.items, L.products, L.unified_orders)


@query("gold_sales_by_region", O.sql("""
    SELECT c.customer_state, o.year, o.month, COUNT(o.order_id) AS total_orders
    FROM unified o JOIN cur_customers c ON o.customer_id = c.customer_id
    GROUP BY c.customer_state, o.year, o.month""", "unified", "cur_customers"))
def q_sales_by_region(spark, sf):
    L = Layers(spark, sf)
    return G.sales_by_region(L.unified_orders, L.customers)


@query("gold_sales_by_payment", O.sql("""
    SELECT p.payment_type, o.year, o.month, CAST(SUM(p.payment_value) AS DOUBLE) AS total_revenue,
           COUNT(p.order_id) AS total_transactions
    FROM s_payments p JOIN unified o ON p.order_id = o.order_id
    GROUP BY p.payment_type, o.year, o.month""", "s_payments", "unified"))
def q_sales_by_payment(spark, sf):
    L = Layers(spark, sf)
    return G.sales_by_payment(L.payments, L.unified_orders)


@query("gold_customer_segmentation", O.sql(f"""
    SELECT c.customer_unique_id, MAX(v.order_purchase_timestamp) AS last_purchase_date,
           COUNT(v.order_id) AS frequency, CAST(SUM(v.final_order_value) AS DOUBLE) AS monetary,
           CAST(DATE '{AS_OF}' - CAST(MAX(v.order_purchase_timestamp) AS DATE) AS INTEGER) AS recency_days
    FROM valued v JOIN cur_customers c ON v.customer_id = c.customer_id
    GROUP BY c.customer_unique_id""", "valued", "cur_customers"))
def q_customer_segmentation(spark, sf):
    L = Layers(spark, sf)
    return G.customer_segmentation(L.unified_orders, L.customers, L.order_values, AS_OF)


@query("gold_order_value_metrics", O.sql("""
    SELECT year, month, CAST(SUM(final_order_value) AS DOUBLE) / COUNT(final_order_value) AS average_ticket,
           CAST(MAX(final_order_value) AS DOUBLE) AS max_ticket, CAST(MIN(final_order_value) AS DOUBLE) AS min_ticket,
           COUNT(order_id) AS total_orders
    FROM valued GROUP BY year, month""", "valued"))
def q_order_value_metrics(spark, sf):
    L = Layers(spark, sf)
    return G.order_value_metrics(L.unified_orders, L.order_values)


# Query groups register themselves on import.
from . import q_brief, q_gold_extra, q_ops, q_quality, q_scd2, q_sources, q_stream  # noqa: E402,F401
