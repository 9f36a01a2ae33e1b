"""Layer assembly: the silver and gold inputs of one data folder.

``Layers(spark, sf_dir)`` names every silver table and the unified order
table as lazy DataFrames built from the raw domain tables. Nothing is
materialised here; the pipeline (``strata.plans.pipeline``) decides what is
written, and queries compose these views.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import lambda_union as L
from ..operators import silver as S
from ..sources import testdata as D
from ..streaming import speed


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    # raw
    @cached_property
    def raw_orders(self) -> DataFrame:
        return D.raw_orders(self.spark, self.sf_dir)

    @cached_property
    def raw_items(self) -> DataFrame:
        return D.raw_order_items(self.spark, self.sf_dir)

    @cached_property
    def raw_payments(self) -> DataFrame:
        return D.raw_payments(self.spark, self.sf_dir)

    @cached_property
    def raw_events(self) -> DataFrame:
        return D.raw_events(self.spark, self.sf_dir)

    @cached_property
    def raw_reviews_df(self) -> DataFrame:
        return D.raw_reviews(self.spark, self.sf_dir)

    # silver
    @cached_property
    def orders(self) -> DataFrame:
        return S.clean_orders(self.raw_orders)

    @cached_property
    def items(self) -> DataFrame:
        return S.clean_order_items(self.raw_items)

    @cached_property
    def order_products(self) -> DataFrame:
        return S.products_by_order(self.raw_items)

    @cached_property
    def payments(self) -> DataFrame:
        return S.clean_payments(self.raw_payments)

    @cached_property
    def products(self) -> DataFrame:
        return S.clean_products(D.raw_products(self.spark, self.sf_dir))

    @cached_property
    def sellers(self) -> DataFrame:
        return S.clean_sellers(D.raw_sellers(self.spark, self.sf_dir))

    @cached_property
    def customers(self) -> DataFrame:
        return S.clean_customers(D.raw_customers(self.spark, self.sf_dir))

    @cached_property
    def geolocation(self) -> DataFrame:
        return S.clean_geolocation(D.raw_geolocation(self.spark, self.sf_dir))

    @cached_property
    def reviews(self) -> DataFrame:
        return S.clean_reviews(D.raw_reviews(self.spark, self.sf_dir))

    @cached_property
    def translation(self) -> DataFrame:
        return D.category_translation(self.spark)

    # speed
    @cached_property
    def valid_events(self) -> DataFrame:
        """Payloads validated and parsed, as the ingest job writes them."""
        valid, _ = speed.ingest_events(D.event_payloads(self.spark, self.sf_dir), watermark=None)
        return valid

    @cached_property
    def stream_orders(self) -> DataFrame:
        """The stream lane gold reads: the validated payloads with the speed
        filter, as the pipeline's speed layer leaves them."""
        return speed.speed_filter(self.valid_events)

    # gold inputs
    @cached_property
    def unified_orders(self) -> DataFrame:
        return L.unify_orders(self.orders, self.stream_orders)

    @cached_property
    def order_values(self) -> DataFrame:
        return L.order_values(self.payments)
