"""SQL serving views over the gold tables (V1–V5).

The gold DataFrames (or tables read back from their folders) are registered
as temp views, and the serving views are plain Spark SQL over them, so a BI
client issuing SQL gets Catalyst's pruning and pushdown through the view.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# view → (base table it reads, SQL)
VIEW_SQL = {
    "v_sales_by_region": ("gold_sales_by_region", """
        SELECT customer_state, year, month, total_orders FROM gold_sales_by_region"""),
    "v_sales_by_category": ("gold_sales_by_category", """
        SELECT product_category_name_english, year, month, sum(total_revenue) AS total_revenue,
               sum(total_items_sold) AS total_items_sold
        FROM gold_sales_by_category GROUP BY product_category_name_english, year, month"""),
    "v_payment_metrics": ("gold_sales_by_payment", """
        SELECT payment_type, year, month, total_revenue, total_transactions FROM gold_sales_by_payment"""),
    "v_pipeline_latency": ("pipeline_file_freshness", """
        SELECT table_name, n_files, mean_age_seconds, max_age_seconds FROM pipeline_file_freshness"""),
    "v_dq_audit_summary": ("dq_results_log", """
        SELECT table_name, expectation, status, count(*) AS n_rules
        FROM dq_results_log GROUP BY table_name, expectation, status"""),
}


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame], views: Sequence[str] | None = None) -> list[str]:
    """Register the base tables, then the serving views (all, or those named) whose inputs exist."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    made = []
    for view, (base, body) in VIEW_SQL.items():
        if (views is None or view in views) and spark.catalog.tableExists(base):
            spark.sql(f"CREATE OR REPLACE TEMP VIEW {view} AS {body}")
            made.append(view)
    return made


# view → (base table, SQL with {db} for the database), for catalog views over
# the pipeline's gold folders
CATALOG_VIEWS = {
    "v_sales_by_region": ("gold_sales_by_region", """
        SELECT customer_state, year, month, total_orders FROM {db}.gold_sales_by_region"""),
    "v_sales_by_category": ("gold_sales_by_category_time", """
        SELECT product_category_name_english, year, month, sum(total_revenue) AS total_revenue,
               sum(total_items_sold) AS total_items_sold
        FROM {db}.gold_sales_by_category_time GROUP BY product_category_name_english, year, month"""),
    "v_payment_metrics": ("gold_sales_by_payment", """
        SELECT payment_type, year, month, total_revenue, total_transactions FROM {db}.gold_sales_by_payment"""),
    "v_dq_audit_summary": ("dq_results", """
        SELECT table_name, expectation, status, count(*) AS n_rules
        FROM {db}.dq_results GROUP BY table_name, expectation, status"""),
}


def register_catalog(spark: SparkSession, tables: Mapping[str, str], database: str = "gold") -> list[str]:
    """External catalog tables over table folders, then persistent serving views.

    ``tables`` maps table name → folder. A partitioned folder gets its
    partitions recovered, so SQL clients see partition pruning. Returns the
    views created (a view whose base table is absent is skipped)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, path in tables.items():
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")
        if _is_partitioned(spark, f"{database}.{name}"):
            spark.sql(f"ALTER TABLE {database}.{name} RECOVER PARTITIONS")
    made = []
    for view, (base, body) in CATALOG_VIEWS.items():
        if base in tables:
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} AS {body.format(db=database)}")
            made.append(view)
    return made


def _is_partitioned(spark: SparkSession, table: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(table))
