"""Column-level functions shared by the operators.

Every function returns a ``Column`` built from built-in Spark expressions,
so it stays inside whole-stage code generation; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- aggregates

def money_sum(col: str | Column) -> Column:
    """Exact decimal sum, published as DOUBLE (one rounding, at the end)."""
    return F.sum(_c(col)).cast("double")


def exact_avg(col: str | Column) -> Column:
    """Exact decimal sum / count, as double (NULLs ignored like ``avg``).

    Unlike ``avg`` over doubles it does not depend on the order in which
    partial sums are merged, so every run and engine gets the same bits."""
    c = _c(col)
    return F.sum(c).cast("double") / F.count(c).cast("double")


# ---------------------------------------------------------------- values

def final_order_value(batch_value: str = "batch_order_value", stream_value: str = "order_value") -> Column:
    """coalesce(payments sum, stream value, 0.00) in decimal(18,2) (L2)."""
    return F.coalesce(F.col(batch_value), F.col(stream_value).try_cast(MONEY), F.lit(0).cast(MONEY)).cast(MONEY)


def band(col: str | Column, bounds: Sequence[tuple[float, str]], top: str) -> Column:
    """Label by the first ``(upper_bound_exclusive, label)`` the value is under; else ``top``."""
    c = _c(col)
    expr = None
    for upper, name in bounds:
        expr = F.when(c < upper, name) if expr is None else expr.when(c < upper, name)
    return expr.otherwise(top) if expr is not None else F.lit(top)


# ---------------------------------------------------------------- dates

def as_date(v: date | str | Column) -> Column:
    return v if isinstance(v, Column) else F.lit(str(v)).cast("date")


def in_date_range(col: str | Column, start: date | str, end: date | str, dtype: T.DataType) -> Column:
    """start <= col < end + 1 day, both dates inclusive, compared in the
    column's own type so Parquet statistics and partition pruning apply."""
    c = _c(col)
    return (c >= as_date(start).cast(dtype)) & (c < F.date_add(as_date(end), 1).cast(dtype))


def year_month(ts: str | Column) -> dict[str, Column]:
    t = _c(ts)
    return {"year": F.year(t), "month": F.month(t)}


def hour_parts(ts: str | Column) -> dict[str, Column]:
    t = _c(ts)
    return {"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t)}


def settled(column: Column) -> Column:
    """``column``, computed once per row at this place of the plan.

    A filter on a costly result (a parsed payload) is otherwise moved below
    the projection that makes it, which repeats the whole expression for
    every condition. Expressions that look non-deterministic stay where they
    are; this condition is always true, and it is allowed on streams.
    """
    return F.when(F.spark_partition_id() >= 0, column)


# ---------------------------------------------------------------- JSON

def object_has_keys(parsed: str | Column, required: Sequence[str]) -> Column:
    """True when the variant ``parsed`` is an object with every required key (null values count)."""
    v = _c(parsed)
    found = [F.try_variant_get(v, f"$['{k}']", "variant").isNotNull() for k in required]
    # least() reads all of its arguments, so a parse that they share is made once
    return F.coalesce(F.least(v.isNotNull(), F.lit(True), *found), F.lit(False))


def has_required_keys(payload: str | Column, required: Sequence[str]) -> Column:
    """True when ``payload`` is a JSON object holding every required key.

    Key presence is checked, not non-null values. Arrays, scalars, malformed
    or truncated text, single-quoted objects, NaN and repeated keys are
    rejected (``try_parse_json`` is NULL for the last four). NULL → false.
    """
    return object_has_keys(F.try_parse_json(_c(payload)), required)
