"""Registered SCD2 queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import scd2 as K
from ..session import ensure_checkpoint_dir
from ..sources import testdata as D
from . import oracle as O
from . import scd2_store as SS
from .layers import Layers
from .registry import query

# Fixed dates: first load, second delivery, and two as-of probes between/after.
FIRST_LOAD = "2024-01-01"
SECOND_LOAD = "2024-01-16"
PROBES = ["2024-01-10", "2024-01-20"]
KEY = "customer_id"
ATTRS = ["customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state", "customer_segment"]


def initial_dim(spark, sf):
    return K.scd2_initial(Layers(spark, sf).customers, FIRST_LOAD)


def merged_dim(spark, sf, mode):
    return K.scd2_merge(initial_dim(spark, sf), D.customer_updates(spark, sf), KEY, SECOND_LOAD, mode=mode)


_COLS = ", ".join([KEY] + ATTRS)
_SAME = " AND ".join(f"u.{c} IS NOT DISTINCT FROM d.{c}" for c in ATTRS)
_UPD_ORDER = ", ".join(f"{c} ASC NULLS LAST" for c in ATTRS)

_DIM0 = f"""dim0 AS (SELECT {_COLS}, DATE '{FIRST_LOAD}' AS effective_date, DATE '9999-12-31' AS end_date,
                 TRUE AS is_current FROM s_customers),
upd AS (SELECT {_COLS} FROM customer_updates WHERE {KEY} IS NOT NULL
        QUALIFY ROW_NUMBER() OVER (PARTITION BY {KEY} ORDER BY {_UPD_ORDER}) = 1)"""

_ALWAYS = f"""
SELECT * FROM dim0 WHERE NOT is_current
UNION ALL
SELECT * FROM dim0 d WHERE is_current AND NOT EXISTS (SELECT 1 FROM upd u WHERE u.{KEY} = d.{KEY})
UNION ALL
SELECT {_COLS}, effective_date, DATE '{SECOND_LOAD}' AS end_date, FALSE AS is_current
FROM dim0 d WHERE is_current AND EXISTS (SELECT 1 FROM upd u WHERE u.{KEY} = d.{KEY})
UNION ALL
SELECT {_COLS}, DATE '{SECOND_LOAD}', DATE '9999-12-31', TRUE FROM upd"""

_ON_CHANGE = f"""
SELECT * FROM dim0 WHERE NOT is_current
UNION ALL
SELECT {_COLS}, effective_date, end_date, is_current FROM (
  SELECT d.*, u.{KEY} IS NOT NULL AS matched, ({_SAME}) AS same
  FROM dim0 d LEFT JOIN upd u ON d.{KEY} = u.{KEY} WHERE d.is_current) j
WHERE NOT matched OR same
UNION ALL
SELECT {_COLS}, effective_date, DATE '{SECOND_LOAD}', FALSE FROM (
  SELECT d.*, ({_SAME}) AS same
  FROM dim0 d JOIN upd u ON d.{KEY} = u.{KEY} WHERE d.is_current) j
WHERE NOT same AND effective_date <> DATE '{SECOND_LOAD}'
UNION ALL
SELECT {_COLS}, DATE '{SECOND_LOAD}', DATE '9999-12-31', TRUE FROM upd u
WHERE NOT EXISTS (SELECT 1 FROM dim0 d WHERE d.is_current AND d.{KEY} = u.{KEY} AND {_SAME})"""


def _with(body: str, *views: str, merged: bool = False) -> str:
    """Prepend the dimension CTEs (dim0, upd and, if asked, merged) to ``body``."""
    base = O.sql("SELECT 1", "s_customers", "customer_updates", *views)
    head = base[: base.rfind("\nSELECT 1")]
    extra = f",\nmerged AS ({_ON_CHANGE})" if merged else ""
    return f"{head},\n{_DIM0}{extra}\n{body.strip()}"


@query("scd2_initial", O.sql(f"""
    SELECT {_COLS}, DATE '{FIRST_LOAD}' AS effective_date, DATE '9999-12-31' AS end_date, TRUE AS is_current
    FROM s_customers""", "s_customers"))
def q_scd2_initial(spark, sf):
    return initial_dim(spark, sf)


@query("scd2_merge_always", _with(_ALWAYS))
def q_scd2_merge_always(spark, sf):
    return merged_dim(spark, sf, "always")


@query("scd2_merge_on_change", _with(_ON_CHANGE))
def q_scd2_merge_on_change(spark, sf):
    return merged_dim(spark, sf, "on_change")


@query("scd2_bucketed_merge", _with(_ON_CHANGE))
def q_scd2_bucketed(spark, sf):
    """K2 on the stored dimension: first load and second delivery in a table by key bucket under the checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark)}/scd2-{uuid.uuid4().hex[:8]}"
    SS.merge(spark, path, Layers(spark, sf).customers, KEY, FIRST_LOAD, ATTRS)
    SS.merge(spark, path, D.customer_updates(spark, sf), KEY, SECOND_LOAD, ATTRS)
    return SS.versions(spark, path).select(KEY, *ATTRS, *K.META)


@query("scd2_as_of", _with(f"""
SELECT p.as_of_date, m.* FROM merged m
JOIN (VALUES {", ".join(f"(DATE '{d}')" for d in PROBES)}) p(as_of_date)
  ON m.effective_date <= p.as_of_date AND p.as_of_date < m.end_date""", merged=True))
def q_scd2_as_of(spark, sf):
    dim = merged_dim(spark, sf, "on_change")
    parts = [K.scd2_as_of(dim, d).select(F.lit(d).cast("date").alias("as_of_date"), *dim.columns) for d in PROBES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("scd2_point_in_time_join", _with(f"""
SELECT f.order_id, f.customer_id, f.event_timestamp, m.customer_state, m.effective_date, m.end_date
FROM stream_orders f LEFT JOIN merged m
  ON f.customer_id = m.{KEY} AND m.effective_date <= CAST(f.event_timestamp AS DATE)
 AND CAST(f.event_timestamp AS DATE) < m.end_date""", "stream_orders", merged=True))
def q_scd2_pit(spark, sf):
    L = Layers(spark, sf)
    facts = L.stream_orders.select("order_id", "customer_id", "event_timestamp")
    dim = merged_dim(spark, sf, "on_change")
    return K.point_in_time_join(facts, dim, KEY, "event_timestamp", ["customer_state"])


@query("scd2_point_in_time_orders", _with(f"""
SELECT f.order_id, f.customer_id, f.order_purchase_timestamp, f.origin, m.customer_state, m.effective_date, m.end_date
FROM unified f LEFT JOIN merged m
  ON f.customer_id = m.{KEY} AND m.effective_date <= CAST(f.order_purchase_timestamp AS DATE)
 AND CAST(f.order_purchase_timestamp AS DATE) < m.end_date""", "unified", merged=True))
def q_scd2_pit_orders(spark, sf):
    """Every order, batch and stream, with the customer version valid on its date (J14); no version before the first load."""
    facts = Layers(spark, sf).unified_orders.select("order_id", "customer_id", "order_purchase_timestamp", "origin")
    return K.point_in_time_join(facts, merged_dim(spark, sf, "on_change"), KEY, "order_purchase_timestamp", ["customer_state"])
