"""Schema contracts: one StructType per domain table, plus enforcement.

Money is ``decimal(18,2)`` end to end; keys keep the integral type of the
source tables. ``enforce_schema`` is the "schema enforcement" step: it casts
with ``try_cast`` (a bad value becomes NULL instead of failing the job under
ANSI mode), adds missing nullable columns, and can report the rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


ORDERS = _schema(
    ("order_id", T.LongType()),
    ("customer_id", T.LongType()),
    ("order_status", T.StringType()),
    ("order_purchase_timestamp", T.TimestampNTZType()),
    ("order_priority", T.StringType()),
)

ORDER_ITEMS = _schema(
    ("order_id", T.LongType()),
    ("order_item_id", T.IntegerType()),
    ("product_id", T.LongType()),
    ("seller_id", T.LongType()),
    ("shipping_limit_date", T.TimestampNTZType()),
    ("price", MONEY),
    ("freight_value", MONEY),
    ("quantity", T.IntegerType()),
    ("discount", T.DecimalType(4, 2)),
)

PAYMENTS = _schema(
    ("order_id", T.LongType()),
    ("payment_sequential", T.IntegerType()),
    ("payment_type", T.StringType()),
    ("payment_installments", T.IntegerType()),
    ("payment_value", MONEY),
    ("paid_at", T.TimestampNTZType()),
)

PRODUCTS = _schema(
    ("product_id", T.LongType()),
    ("product_name", T.StringType()),
    ("product_brand", T.StringType()),
    ("product_category_name", T.StringType()),
    ("product_size", T.IntegerType()),
    ("list_price", MONEY),
)

SELLERS = _schema(
    ("seller_id", T.LongType()),
    ("seller_name", T.StringType()),
    ("seller_zip_code_prefix", T.IntegerType()),
    ("seller_state", T.StringType()),
)

CUSTOMERS = _schema(
    ("customer_id", T.LongType()),
    ("customer_unique_id", T.LongType()),
    ("customer_zip_code_prefix", T.IntegerType()),
    ("customer_city", T.StringType()),
    ("customer_state", T.StringType()),
    ("customer_segment", T.StringType()),
)

GEOLOCATION = _schema(
    ("geolocation_zip_code_prefix", T.IntegerType()),
    ("geolocation_lat", T.DoubleType()),
    ("geolocation_lng", T.DoubleType()),
    ("geolocation_city", T.StringType()),
    ("geolocation_state", T.StringType()),
    ("source_row_id", T.LongType()),
)

TRANSLATION = _schema(
    ("product_category_name", T.StringType()),
    ("product_category_name_english", T.StringType()),
)

REVIEWS = _schema(
    ("review_id", T.LongType()),
    ("order_id", T.LongType()),
    ("review_score", T.IntegerType()),
    ("review_comment_title", T.StringType()),
    ("review_comment_message", T.StringType()),
)

# Event contract of the speed layer (the five fields every producer sends).
EVENTS = _schema(
    ("order_id", T.LongType()),
    ("customer_id", T.LongType()),
    ("order_status", T.StringType()),
    ("event_timestamp", T.TimestampType()),
    ("order_value", T.DoubleType()),
)
EVENT_REQUIRED_KEYS = [f.name for f in EVENTS.fields]

# One DQ result row (also the layout of the result log table).
DQ_RESULT = _schema(
    ("table_name", T.StringType()),
    ("expectation", T.StringType()),
    ("column", T.StringType()),
    ("status", T.StringType()),
    ("observed_value", T.DoubleType()),
    ("threshold", T.StringType()),
    ("severity", T.StringType()),
)


def enforce_schema(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project ``df`` onto ``contract``: try_cast each column, null-fill missing ones.

    Extra columns are dropped. Nothing is eager.
    """
    present = set(df.columns)
    cols: list[Column] = []
    for field in contract.fields:
        if field.name in present:
            src = F.col(field.name)
            if df.schema[field.name].dataType == field.dataType:
                cols.append(src.alias(field.name))
            else:
                cols.append(src.try_cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*cols)


def cast_rejects(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Rows where a present, non-null value did not survive ``try_cast``.

    Adds ``rejected_columns`` (array of column names) and keeps only rejects.
    """
    checks = []
    for field in contract.fields:
        if field.name in df.columns and df.schema[field.name].dataType != field.dataType:
            c = F.col(field.name)
            checks.append(F.when(c.isNotNull() & c.try_cast(field.dataType).isNull(), F.lit(field.name)))
    if not checks:
        return df.withColumn("rejected_columns", F.array().cast("array<string>")).limit(0)
    bad = F.array_compact(F.array(*checks))
    return df.withColumn("rejected_columns", bad).filter(F.size("rejected_columns") > 0)


def schema_diff(df: DataFrame, contract: T.StructType, table_name: str = "") -> list[tuple]:
    """Compare a schema with a contract (driver-side metadata only, no data read).

    Returns (table, column, expected, actual, problem) tuples.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for field in contract.fields:
        if field.name not in actual:
            out.append((table_name, field.name, field.dataType.simpleString(), None, "missing"))
        elif actual[field.name] != field.dataType:
            out.append((table_name, field.name, field.dataType.simpleString(),
                        actual[field.name].simpleString(), "type"))
    expected = {f.name for f in contract.fields}
    for name, dtype in actual.items():
        if name not in expected:
            out.append((table_name, name, None, dtype.simpleString(), "unexpected"))
    return out
