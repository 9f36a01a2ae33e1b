"""strata: a layered lakehouse pipeline (raw → silver → gold, speed layer,
data quality, SCD2, table upkeep) built on Spark DataFrames.

The names below are the public API; the modules hold the rest.
"""

from .operators.dedup import dedup_latest, duplicate_keys
from .operators.lambda_union import order_values, origin_counts, unify_orders, valued_orders
from .operators.quality import (Between, CastsCleanly, DataQualityError, ExistsIn, NotNull, OrderIsTotal, RuleSet, Unique, gate,
                                null_profile, observe_rules, report, run_rules, summary)
from .operators.scd2 import point_in_time_join, scd2_as_of, scd2_current, scd2_initial, scd2_merge
from .plans.maintenance import (compact, date_slice, expired_partitions, freshness, incremental_slice, inventory,
                                publish_swap, readiness, upsert)
from .plans.pipeline import PipelineConfig, run
from .plans.writers import write_table
from .session import cluster_conf, get_session
from .sources.contracts import cast_rejects, enforce_schema, schema_diff
from .streaming.speed import has_required_keys, ingest_events, speed_filter

__all__ = [
    "dedup_latest", "duplicate_keys", "order_values", "origin_counts", "unify_orders", "valued_orders",
    "Between", "CastsCleanly", "DataQualityError", "ExistsIn", "NotNull", "OrderIsTotal", "RuleSet", "Unique", "gate",
    "null_profile",
    "observe_rules", "report", "run_rules", "summary", "point_in_time_join", "scd2_as_of", "scd2_current",
    "scd2_initial", "scd2_merge", "compact", "date_slice", "expired_partitions", "freshness", "incremental_slice",
    "inventory", "publish_swap", "readiness", "upsert", "PipelineConfig", "run", "write_table", "cluster_conf",
    "get_session", "cast_rejects", "enforce_schema", "schema_diff", "has_required_keys", "ingest_events",
    "speed_filter",
]
