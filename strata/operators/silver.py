"""Raw → silver transforms.

Each table: contract projection, deterministic dedup on its key, derived
columns. All lazy; the writers in ``strata.plans.writers`` materialise them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import year_month
from ..sources import contracts as C
from ..sources.testdata import UNKNOWN_CATEGORY
from .dedup import dedup_latest

# Dedup keys and survivor orderings per silver table (orderings are built
# per call: a Column needs an active session). ``total=True`` (the silver write)
# adds every other column, for deliveries whose rows tie on the declared order.
ITEM_KEYS = ["order_id", "order_item_id"]
def ITEM_PRODUCT_ORDER():
    return [F.col("shipping_limit_date").desc_nulls_last(), "product_id"]
def ITEM_ORDER():
    return [*ITEM_PRODUCT_ORDER(), "seller_id", F.col("price").desc_nulls_last()]
PAYMENT_KEYS = ["order_id", "payment_sequential"]
def PAYMENT_ORDER(payments: DataFrame):
    ties = [c for c in ("product_id", "seller_id") if c in payments.columns]  # a delivery may lack them
    return [F.col("paid_at").desc_nulls_last(), *ties, F.col("payment_value").desc_nulls_last()]
def ORDER_ORDER():
    return [F.col("order_purchase_timestamp").desc_nulls_last(), "order_status", "customer_id"]

# Fill-ins for empty review text.
REVIEW_TITLE_FILL = ""
REVIEW_MESSAGE_FILL = "sin_comentario"


def latest_first(df: DataFrame) -> list:
    """Order by the delivery's change time, where it has one."""
    return [F.col("updated_at").desc_nulls_last()] if "updated_at" in df.columns else []


def add_year_month(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns(year_month(ts))


def clean_orders(orders: DataFrame, total: bool = False) -> DataFrame:
    """Orders: one row per order_id (latest purchase time wins), with year/month."""
    deduped = dedup_latest(orders, ["order_id"], latest_first(orders) + ORDER_ORDER(), total)
    return add_year_month(deduped, "order_purchase_timestamp")


def clean_order_items(items: DataFrame, total: bool = False) -> DataFrame:
    return dedup_latest(items, ITEM_KEYS, latest_first(items) + ITEM_ORDER(), total)


def clean_payments(payments: DataFrame, total: bool = False) -> DataFrame:
    deduped = dedup_latest(payments, PAYMENT_KEYS, latest_first(payments) + PAYMENT_ORDER(payments), total)
    return deduped.select(*[f.name for f in C.PAYMENTS.fields], *[c for c in ("updated_at",) if c in payments.columns])


def clean_products(products: DataFrame, total: bool = False) -> DataFrame:
    return dedup_latest(products, ["product_id"], latest_first(products) + ["product_name", "product_category_name"], total)


def clean_sellers(sellers: DataFrame, total: bool = False) -> DataFrame:
    return dedup_latest(sellers, ["seller_id"], latest_first(sellers) + ["seller_name", "seller_state"], total)


def clean_customers(customers: DataFrame, total: bool = False) -> DataFrame:
    return dedup_latest(customers, ["customer_id"], latest_first(customers) + ["customer_unique_id", "customer_state"], total)


def clean_geolocation(geo: DataFrame, total: bool = False) -> DataFrame:
    """One row per zip prefix: the latest change, then the lowest source row id survives."""
    return dedup_latest(geo, ["geolocation_zip_code_prefix"], latest_first(geo) + ["source_row_id"], total)


def clean_reviews(reviews: DataFrame, single_key: bool = False, total: bool = False) -> DataFrame:
    """Reviews keyed by (review_id, order_id); ``single_key`` keys by review_id only."""
    keys = ["review_id"] if single_key else ["review_id", "order_id"]
    deduped = dedup_latest(reviews, keys, latest_first(reviews) + ["order_id", F.col("review_score").desc_nulls_last()], total)
    return fill_review_text(deduped)


def fill_review_text(reviews: DataFrame) -> DataFrame:
    return reviews.fillna({"review_comment_title": REVIEW_TITLE_FILL,
                           "review_comment_message": REVIEW_MESSAGE_FILL})


def delivered_only(orders: DataFrame, status_col: str = "order_status", delivered: str = "delivered") -> DataFrame:
    return orders.filter(F.col(status_col) == delivered)


def null_columns(df: DataFrame, cols: list[str] | None = None) -> list[str]:
    """Columns that are entirely NULL, found with one aggregate pass (none for no columns)."""
    cols = df.columns if cols is None else cols
    if not cols:
        return []
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in cols]).first()
    return [c for c in cols if counts[c] == 0]


def drop_null_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.drop(*null_columns(df, cols))


def translate_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    """products ⟕ translation; categories without a translation become "otros"."""
    t = translation.select("product_category_name", "product_category_name_english")
    return products.join(t, "product_category_name", "left").withColumn(
        "product_category_name_english",
        F.coalesce(F.col("product_category_name_english"), F.lit(UNKNOWN_CATEGORY)),
    )


def enrich_items(items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """items ⟕ products ⟕ sellers (J10). Dimension sides are pruned to what is used;
    the planner broadcasts them when their measured size is under the threshold."""
    p = products.select("product_id", "product_category_name")
    s = sellers.select("seller_id", "seller_state")
    return items.join(p, "product_id", "left").join(s, "seller_id", "left")


def items_with_order_partition(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items carrying the order's year/month, for an order-aligned layout."""
    return items.join(orders.select("order_id", "year", "month"), "order_id", "left")


def items_by_order(items: DataFrame, orders: DataFrame, total: bool = False) -> DataFrame:
    """``clean_order_items`` with the order's year/month, from raw items in one exchange: rows are brought together by
    order, which holds for the dedup and for the join. Items of no order, however many, meet no order and keep the
    dedup of their own, which reduces them before they are sent."""
    of_order = items.where(F.col("order_id").isNotNull()).repartition("order_id")
    of_order = items_with_order_partition(clean_order_items(of_order, total), orders)
    loose = clean_order_items(items.where(F.col("order_id").isNull()), total)
    kinds = {c: F.lit(None).cast(of_order.schema[c].dataType) for c in ("year", "month")}
    return of_order.unionByName(loose.withColumns(kinds))


def products_by_order(items: DataFrame) -> DataFrame:
    """order_id and product_id of ``clean_order_items`` where there is an order, in one exchange by order, which also holds
    for grouping by it. The order up to the product settles the survivor's product; what breaks ties after it is not read."""
    of_order = items.where(F.col("order_id").isNotNull()).repartition("order_id")
    return dedup_latest(of_order, ITEM_KEYS, latest_first(items) + ITEM_PRODUCT_ORDER()).select("order_id", "product_id")


def with_geo(df: DataFrame, geo_dim: DataFrame, zip_col: str) -> DataFrame:
    """``df`` ⟕ deduplicated geolocation on its zip prefix column."""
    g = geo_dim.select(F.col("geolocation_zip_code_prefix").alias(zip_col), "geolocation_lat", "geolocation_lng")
    return df.join(g, zip_col, "left")


def customers_with_geo(customers: DataFrame, geo_dim: DataFrame) -> DataFrame:
    return with_geo(customers, geo_dim, "customer_zip_code_prefix")


def sellers_with_geo(sellers: DataFrame, geo_dim: DataFrame) -> DataFrame:
    return with_geo(sellers, geo_dim, "seller_zip_code_prefix")
