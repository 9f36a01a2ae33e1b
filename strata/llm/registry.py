"""Queries of this subpackage: name -> (function of (spark, sf_dir), DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = (
    "quality_rules", "license_scan", "topk_search", "jaccard_join", "viterbi", "token_files", "token_count", "packing", "secret_scan", "toxicity",
    "periodic_runs", "substring_dedup", "whitening",
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

for _name in MODULES:
    _module = import_module(f"{__package__}.{_name}")
    QUERIES[_module.QUERY] = _module.query
    if _module.ORACLE is not None:
        ORACLES[_module.QUERY] = _module.ORACLE
