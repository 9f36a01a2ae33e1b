"""From raw documents to packed training sequences.

The stages, in order: quality rules (rejected documents go, kept ones lose
their failing lines), toxicity (toxic documents go), n-gram Jaccard join (one
document of each group of near copies stays), secret scans (secrets are
replaced), best-fit packing (token pieces and their sequences). Every stage
works on all that the one before kept; all but the last return the columns of
``documents``. Each result is written as Parquet and read again, so a lost
executor costs the work of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import jaccard_join, packing, quality_rules, secret_scan, toxicity
from strata.llm.common import written

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("toxicity", toxicity.stage),
    ("jaccard_join", jaccard_join.stage),
    ("secret_scan", secret_scan.stage),
    ("packing", packing.stage),
]

# Tokenizer ids, a fitted model and connected components: tests/llm/test_corpus_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole ``documents`` table of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
