"""Raw tables by contract: where a table lies and what its columns are called.

A ``Binding`` names one raw table (path, format, column names); ``BoundTables``
holds one per table of the pipeline and reads each delivery as its contract
says: columns renamed, values converted with ``try_cast``, missing columns
NULL (or a declared default). Keys keep the type they come in, text or whole
numbers, so ids like ``e481f51c...`` and zip codes with leading zeros stay as
they are. Columns of ``CARRIED`` (change time, delivery dates, review times,
product sizes) are kept where a delivery has them; other columns are dropped.

``rejects`` are the rows of a delivery that hold a value the contract cannot
take. ``FixtureTables`` gives the same interface over the driver's tables.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import contracts as C
from . import testdata as D

#: The raw tables of the pipeline and their contracts.
CONTRACTS = {
    "orders": C.ORDERS, "order_items": C.ORDER_ITEMS, "payments": C.PAYMENTS, "products": C.PRODUCTS,
    "sellers": C.SELLERS, "customers": C.CUSTOMERS, "geolocation": C.GEOLOCATION, "reviews": C.REVIEWS,
    "translation": C.TRANSLATION,
}

#: Identifiers: kept as text or whole numbers, as they come.
KEYS = {"order_id", "customer_id", "customer_unique_id", "product_id", "seller_id", "review_id",
        "customer_zip_code_prefix", "seller_zip_code_prefix", "geolocation_zip_code_prefix"}

_TIME = T.TimestampNTZType()
_INT = T.IntegerType()
#: Columns beyond the contract that are kept where a delivery has them.
CARRIED = {
    "orders": {"order_approved_at": _TIME, "order_delivered_carrier_date": _TIME, "order_delivered_customer_date": _TIME,
               "order_estimated_delivery_date": _TIME, "updated_at": _TIME},
    "order_items": {"updated_at": _TIME},
    "payments": {"updated_at": _TIME},
    "products": {"product_name_length": _INT, "product_description_length": _INT, "product_photos_qty": _INT,
                 "product_weight_g": _INT, "product_length_cm": _INT, "product_height_cm": _INT, "product_width_cm": _INT,
                 "updated_at": _TIME},
    "sellers": {"seller_city": T.StringType(), "updated_at": _TIME},
    "customers": {"updated_at": _TIME},
    "geolocation": {"updated_at": _TIME},
    "reviews": {"review_creation_date": _TIME, "review_answer_timestamp": _TIME, "updated_at": _TIME},
    "translation": {},
}


def contract_of(name: str, df: DataFrame) -> T.StructType:
    """The contract of table ``name`` for a delivery: its keys' own types, its carried columns."""
    given = {f.name: f.dataType for f in df.schema.fields}

    def kind(f: T.StructField) -> T.DataType:
        own = given.get(f.name)
        if f.name in KEYS and isinstance(own, (T.StringType, T.IntegralType)):
            return own
        return f.dataType

    carried = [T.StructField(c, t) for c, t in CARRIED[name].items() if c in given]
    return T.StructType([T.StructField(f.name, kind(f)) for f in CONTRACTS[name].fields] + carried)


@dataclass(frozen=True)
class Binding:
    """One raw table. ``columns``: contract name -> name in the source; ``defaults``: contract name -> value for a column it lacks."""
    path: str
    columns: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)
    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        """The delivery under its contract names, its own types."""
        df = spark.read.format(self.fmt).options(**self.options).load(self.path)
        missing = sorted(set(self.columns.values()) - set(df.columns))
        if missing:
            raise ValueError(f"{self.path} has no column {', '.join(missing)}")
        named = {source: name for name, source in self.columns.items()}
        taken = set(named.values())
        cols = [F.col(f"`{c}`").alias(named.get(c, c)) for c in df.columns if c in named or c not in taken]
        out = df.select(*cols)
        return out.withColumns({c: F.lit(v) for c, v in self.defaults.items() if c not in out.columns})


@dataclass(frozen=True)
class BoundTables:
    """The raw tables of a user: table name -> Binding. Tables left out are read as empty.

    ``weather``: an optional table (obs_hour, temperature, readings).
    """
    tables: Mapping[str, Binding]

    def __post_init__(self):
        unknown = sorted(set(self.tables) - set(CONTRACTS) - {"weather"})
        if unknown:
            raise ValueError(f"no such raw table: {', '.join(unknown)}")

    @classmethod
    def from_json(cls, text: str) -> "BoundTables":
        """{"orders": {"path": ..., "columns": {...}, "defaults": {...}, "fmt": ..., "options": {...}}, ...}"""
        return cls({name: Binding(**spec) for name, spec in json.loads(text).items()})

    def raw(self, spark: SparkSession, name: str) -> DataFrame:
        if name not in self.tables:
            return spark.createDataFrame([], CONTRACTS[name])
        return self.tables[name].read(spark)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        raw = self.raw(spark, name)
        return C.enforce_schema(raw, contract_of(name, raw))

    def rejects(self, spark: SparkSession, name: str) -> DataFrame | None:
        """Rows (table_name, rejected_columns, payload) whose values do not convert; None if no type differs."""
        raw = self.raw(spark, name)
        contract = contract_of(name, raw)
        if not self.converted(spark, name):
            return None
        bad = C.cast_rejects(raw, contract)
        return bad.select(F.lit(name).alias("table_name"), "rejected_columns",
                          F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns])).alias("payload"))

    def converted(self, spark: SparkSession, name: str) -> list[tuple[str, str]]:
        """(column, contract type) of the delivery's columns that have another type."""
        raw = self.raw(spark, name)
        return [(f.name, f.dataType.simpleString()) for f in contract_of(name, raw).fields
                if f.name in raw.columns and raw.schema[f.name].dataType != f.dataType]

    def weather(self, spark: SparkSession) -> DataFrame | None:
        return self.tables["weather"].read(spark) if "weather" in self.tables else None


@dataclass(frozen=True)
class FixtureTables:
    """The driver's tables as raw deliveries (``testdata``); ``updates``: the second delivery of customers."""
    sf_dir: str
    updates: bool = False

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        if name == "translation":
            return D.category_translation(spark)
        if name == "payments":  # keeps its tie-break columns
            return D.raw_payments(spark, self.sf_dir)
        if name == "customers" and self.updates:
            return C.enforce_schema(D.customer_updates(spark, self.sf_dir), C.CUSTOMERS)
        read = {"orders": D.raw_orders, "order_items": D.raw_order_items, "products": D.raw_products, "sellers": D.raw_sellers,
                "customers": D.raw_customers, "geolocation": D.raw_geolocation, "reviews": D.raw_reviews}[name]
        return C.enforce_schema(read(spark, self.sf_dir), CONTRACTS[name])

    def rejects(self, spark: SparkSession, name: str) -> None:
        return None

    def converted(self, spark: SparkSession, name: str) -> list[tuple[str, str]]:
        return []

    def weather(self, spark: SparkSession) -> DataFrame:
        return D.weather_hourly(spark, self.sf_dir)
