"""Deterministic key deduplication.

``dropDuplicates(keys)`` keeps an arbitrary survivor, so two runs (or two
consumers of the same plan) may disagree. ``dedup_latest`` keeps the first
row of each key under a declared order.

Plan shape: ``row_number() = 1`` lets Catalyst insert a partial
``WindowGroupLimit`` before the shuffle, so each map task sends at most one
row per key. A key holding a third of all rows therefore costs one row per
input partition in the exchange, not a third of the table in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RN = "__strata_rn"


def order_cols(order_by: Sequence[Column | str]) -> list[Column]:
    """Strings sort ascending with NULLs last; Columns are used as given."""
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str],
                 total: bool = False) -> DataFrame:
    """Keep one row per ``keys``: the first under ``order_by``.

    NULL keys form one group (as ``dropDuplicates`` does). Only the keys, the
    order and what the caller reads reach the scan. Rows that tie on the whole
    order are told apart by ``total``: all other columns then follow as
    tie-breakers, at the price of reading and sorting them, so it belongs where
    every column is read anyway (the silver write). ``quality.OrderIsTotal``
    counts the ties that a declared order leaves.
    """
    order = list(order_by)
    if total:
        named = {c for c in order if isinstance(c, str)} | set(keys)
        order += sorted(f.name for f in df.schema.fields
                        if f.name not in named and not isinstance(f.dataType, (T.MapType, T.VariantType)))
    w = Window.partitionBy(*keys).orderBy(*order_cols(order))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (A10)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)
