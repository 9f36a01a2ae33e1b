"""End-to-end pipeline: raw → silver → DQ audit → speed layer → gold → upkeep.

``run(spark, cfg, stages)`` calls the stages in the order of the reference's
daily schedule. State passes between stages only as tables under
``cfg.out_root`` (as between separate jobs on a cluster), so any stage can be
re-run alone, and an executor loss inside a stage only re-runs its tasks.
A ``DataQualityError`` from the audit halts the run before gold is touched.

Layout under ``out_root``::

    silver/fact_*/               facts: dynamic partition overwrite (a run or backfill
                                 replaces exactly the partitions it produces)
    silver/dim_*/, reviews       full-refresh tables, published by write + row check + swap
    silver/dim_customers/        SCD2 dimension, published by write + row check + swap
    stream/raw (valid + rejected payloads), stream/processed, stream/late, stream/hourly_counts,
    stream/demand_alerts, stream/_checkpoints
    gold/<table>/...             gold tables, published by swap (lambda_orders first, read back)
    dq/results                   DQ result log (append)
    ops/inventory                file / byte / row inventory
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..operators import brief as B
from ..operators import gold as G
from ..operators import gold_extra as GX
from ..operators import lambda_union as LU
from ..operators import quality as Q
from ..operators import scd2 as K
from ..operators import silver as S
from ..sources import contracts as C
from ..sources.binding import CARRIED, CONTRACTS, KEYS, BoundTables, FixtureTables, contract_of
from ..streaming import jobs
from . import maintenance as MT
from . import scd2_store as SS
from .serving import register_catalog
from .writers import write_table

STAGES = ["raw_to_silver", "dq_audit", "speed_layer", "silver_to_gold", "maintenance"]

# Order of the rows within the files of the silver tables.
CLUSTERED = {"fact_orders": ["order_id"], "fact_order_items": ["order_id"], "fact_payments": ["order_id"],
             "dim_customers": ["customer_id"]}

MOST = 1_000_000_000  # no price, freight or payment is larger
# Silver tables whose columns are held against the contract. Partition columns come back as Spark reads them, so
# tables laid out by a column of the contract are left out.
AUDITED = {"orders": "fact_orders", "order_items": "fact_order_items", "products": "dim_products"}

HOURLY_SCHEMA = T.StructType([T.StructField("window_start", T.TimestampType()),
                              T.StructField("window_end", T.TimestampType()),
                              T.StructField("order_status", T.StringType()),
                              T.StructField("n_events", T.LongType()),
                              T.StructField("total_value", T.DoubleType())])


@dataclass
class PipelineConfig:
    sf_dir: str                      # raw input tables
    out_root: str                    # lakehouse root
    as_of: str                       # business date of the run (SCD2 dates, recency)
    payload_dir: str | None = None   # landing folder of event payload files (topic stand-in)
    customer_updates: bool = False   # use the second customer delivery (SCD2 merge)
    halt_on_dq: bool = True
    extra_gold: bool = True
    catalog_database: str | None = None   # register gold as catalog tables + serving views
    date_range: tuple[str, str] | None = None   # backfill: re-derive facts of these dates only (M7)
    retention_days: int = 365        # raw stream events older than this are removed by the maintenance stage (M8)
    sources: BoundTables | None = None   # the user's raw tables; by default those of ``sf_dir``
    results: dict = field(default_factory=dict)

    @property
    def tables(self) -> BoundTables | FixtureTables:
        return self.sources or FixtureTables(self.sf_dir, self.customer_updates)

    def p(self, *parts: str) -> str:
        return os.path.join(self.out_root, *parts)


def read_optional(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table that may not exist yet: missing path → empty DataFrame of the contract.

    Only a missing path is tolerated; any other read error propagates."""
    if not MT.path_exists(spark, path):
        return spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


# ---------------------------------------------------------------- stages

def raw_to_silver(spark: SparkSession, cfg: PipelineConfig) -> None:
    # every raw delivery is projected onto its contract first (try_cast, missing
    # columns NULL-filled, extra columns dropped)
    raw = {name: cfg.tables.read(spark, name) for name in CONTRACTS}
    # soft gate on the raw deliveries (log only), as the reference does before dedup
    soft = [Q.run_rules(raw["orders"], "raw_orders", [Q.NotNull("order_id", 0.01, Q.WARN), Q.Unique("order_id", Q.WARN)]),
            Q.run_rules(raw["customers"], "raw_customers",
                        [Q.NotNull("customer_id", 0.01, Q.WARN), Q.Unique("customer_id", Q.WARN)])]
    soft += _quarantine_rejects(spark, cfg)
    _log_results(cfg, Q.union_results(*soft))

    # facts: dynamic partition overwrite. With ``date_range`` (backfill) only
    # orders of that range, and their items, are re-derived and replaced row by
    # row; the slice is taken after dedup, so the survivor of a key does not
    # depend on the range.
    orders = S.clean_orders(raw["orders"], total=True)
    orders_path, items_path = cfg.p("silver", "fact_orders"), cfg.p("silver", "fact_order_items")
    if cfg.date_range:
        _backfill_facts(spark, cfg, orders, S.clean_order_items(raw["order_items"], total=True))
    else:
        write_table(orders, orders_path, ["year", "month"], dynamic=True, cluster_by=["order_id"])
        items = S.items_by_order(raw["order_items"], _silver(spark, cfg, "fact_orders"), total=True)
        write_table(items, items_path, ["year", "month"], dynamic=True, cluster_by=["order_id"])
    # payments are laid out by payment_type, which a date range does not align
    # with, so they are always rewritten whole; its few values make few files per
    # task of the dedup, so they are written from there, not exchanged once more
    write_table(S.clean_payments(raw["payments"], total=True), cfg.p("silver", "fact_payments"),
                ["payment_type"], dynamic=True)
    # full-refresh dimensions: published by write + row check + swap
    products = S.clean_products(raw["products"], total=True)
    # carried columns that the delivery never fills are left out (one pass over them alone)
    unfilled = S.null_columns(raw["products"], [c for c in products.columns if c in CARRIED["products"]])
    dims = {
        "dim_products": (products.drop(*unfilled), None),
        "dim_sellers": (S.clean_sellers(raw["sellers"], total=True), ["seller_state"]),
        "dim_geolocation": (S.clean_geolocation(raw["geolocation"], total=True), ["geolocation_state"]),
        "fact_order_reviews": (S.clean_reviews(raw["reviews"], total=True), ["review_score"]),
        "dim_category_translation": (raw["translation"], None),
    }
    for name, (df, parts) in dims.items():
        MT.publish_swap(spark, df, cfg.p("silver", name), parts)

    # SCD2 customers: first load, or merge into the published dimension; a
    # backfill of facts leaves the dimension's history alone
    dim_path = cfg.p("silver", "dim_customers")
    MT.recover(spark, dim_path)
    if cfg.date_range and MT.path_exists(spark, dim_path):
        return
    delivery = S.clean_customers(raw["customers"], total=True)
    # a new change time alone is no new version
    tracked = [c for c in delivery.columns if c not in ("customer_id", "updated_at")]
    merged = SS.merge(spark, dim_path, delivery, "customer_id", cfg.as_of, tracked)
    cfg.results["dim_customers_rows"] = merged["rows"]
    if cfg.catalog_database:
        # external catalog tables over the silver folders (W1), partitions recovered
        silver = {t: cfg.p("silver", t) for t in MT.list_tables(spark, cfg.p("silver"))}
        register_catalog(spark, silver, f"{cfg.catalog_database}_silver")


def _silver(spark: SparkSession, cfg: PipelineConfig, table: str) -> DataFrame:
    return spark.read.parquet(cfg.p("silver", table))


def _quarantine_rejects(spark: SparkSession, cfg: PipelineConfig) -> list[DataFrame]:
    """Rows with values that a contract cannot take go to dq/rejects, with the names of the columns, per table
    and run date; their counts per column are results of the soft gate. One scan per table that has such columns."""
    results = []
    for name in CONTRACTS:
        rejects = cfg.tables.rejects(spark, name)
        if rejects is None:
            continue
        tagged = rejects.withColumn("run_date", F.lit(cfg.as_of).cast("date")).drop("table_name")
        write_table(tagged, cfg.p("dq", "rejects", f"table_name={name}"), ["run_date"], dynamic=True)
        rules = [Q.CastsCleanly(c, t, Q.WARN) for c, t in cfg.tables.converted(spark, name)]
        results.append(Q.run_rules(cfg.tables.raw(spark, name), f"raw_{name}", rules))
    return results


def _backfill_facts(spark: SparkSession, cfg: PipelineConfig, orders: DataFrame, items: DataFrame) -> None:
    """Replace the orders of the date range, older copies of them, and their items; keep all other rows."""
    orders_path, items_path = cfg.p("silver", "fact_orders"), cfg.p("silver", "fact_order_items")
    part = MT.date_slice(orders, "order_purchase_timestamp", *cfg.date_range)
    stale = part.select("order_id")
    if MT.path_exists(spark, orders_path):
        stale = stale.union(MT.date_slice(spark.read.parquet(orders_path), "order_purchase_timestamp",
                                          *cfg.date_range).select("order_id"))
    stale_path = cfg.p("ops", f".__stale_{uuid.uuid4().hex[:8]}")
    write_table(stale.distinct(), stale_path)  # the table it is read from is about to change
    stale = spark.read.parquet(stale_path)
    MT.replace_rows(spark, part, orders_path, ["year", "month"], stale, ["order_id"])
    new_orders = MT.date_slice(spark.read.parquet(orders_path), "order_purchase_timestamp", *cfg.date_range)
    new_items = S.items_with_order_partition(items.join(new_orders.select("order_id"), "order_id", "left_semi"), new_orders)
    MT.replace_rows(spark, new_items, items_path, ["year", "month"], stale, ["order_id"])
    MT.remove_path(spark, stale_path)


def dq_audit(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Hard gate over the published silver tables (reads files, not lineage)."""
    sv = lambda t: spark.read.parquet(cfg.p("silver", t))
    cust = sv("dim_customers")
    results = Q.union_results(
        Q.run_rules(cust, "dim_customers", [Q.NotNull("customer_id")]),
        Q.run_rules(K.scd2_current(cust), "dim_customers_current", [Q.Unique("customer_id")]),
        Q.run_rules(sv("fact_orders"), "fact_orders",
                    [Q.NotNull("order_id"), Q.Unique("order_id"),
                     Q.ExistsIn("customer_id", K.scd2_current(cust), "customer_id", Q.WARN)]),
        Q.run_rules(sv("fact_order_items"), "fact_order_items",
                    [Q.Unique(["order_id", "order_item_id"]), Q.ExistsIn("product_id", sv("dim_products"), "product_id"),
                     Q.Between("quantity", 0, 1_000_000, Q.WARN), Q.NotNull("price", 0.0, Q.WARN), Q.Between("price", 0, MOST, Q.WARN),
                     Q.Between("freight_value", 0, MOST, Q.WARN)]),
        Q.run_rules(sv("fact_payments"), "fact_payments",
                    [Q.Unique(["order_id", "payment_sequential"]), Q.NotNull("payment_value", 0.0, Q.WARN),
                     Q.Between("payment_value", 0, MOST, Q.WARN)]),
        Q.run_rules(sv("fact_order_reviews"), "fact_order_reviews", [Q.Between("review_score", 1, 5)]),
        *(_schema_check(sv(table), name, table) for name, table in AUDITED.items()),
    )
    logged = _log_results(cfg, results)
    cfg.results["dq_passed"] = Q.gate(logged, halt=cfg.halt_on_dq)


def _schema_check(silver: DataFrame, name: str, table: str) -> DataFrame:
    """Columns of the contract that a silver table lacks or holds in another type (its keys' own types are right)."""
    contract = T.StructType([f for f in contract_of(name, silver).fields if f.name in CONTRACTS[name].names])
    return Q.schema_results(silver.select(*[c for c in silver.columns if c in contract.names]), contract, table,
                            silver.sparkSession)


def speed_layer(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Drain the payload landing folder: ingest → raw events → processed events."""
    if not cfg.payload_dir:
        return
    ck = cfg.p("stream", "_checkpoints")
    events = event_schema(spark, cfg)
    jobs.ingest_job(jobs.file_payload_source(spark, cfg.payload_dir), cfg.p("stream", "raw"),
                    f"{ck}/ingest", schema=events).awaitTermination()
    # the dimension is looked up per micro-batch and reduced to one current row
    # per customer there, whatever other stages have checked
    customers = jobs.folder_dimension(cfg.p("silver", "dim_customers"))
    q = jobs.process_job(jobs.valid_event_source(spark, cfg.p("stream", "raw"), events), customers,
                         cfg.p("stream", "processed"), f"{ck}/processed")
    # tumbling hourly demand per status, scored against the previous hours as
    # each window closes (real-time alerts); an independent query over the
    # same raw table, drained concurrently
    h = jobs.demand_alerts_job(jobs.valid_event_source(spark, cfg.p("stream", "raw"), events).drop("is_valid"),
                               cfg.p("stream", "hourly_counts"), cfg.p("stream", "demand_alerts"),
                               f"{ck}/hourly_counts")
    q.awaitTermination()
    h.awaitTermination()
    # what the watermark dropped goes to a table of its own, which gold reads too
    cfg.results["late_rows_dropped"] = jobs.dropped_by_watermark(q)
    jobs.late_rows_job(jobs.valid_event_source(spark, cfg.p("stream", "raw"), events), customers, cfg.p("stream", "processed"),
                       cfg.p("stream", "late"), f"{ck}/late").awaitTermination()


def event_schema(spark: SparkSession, cfg: PipelineConfig) -> T.StructType:
    """The event contract with the key types of the batch orders (text or whole numbers)."""
    keys = {f.name: f.dataType for f in _silver(spark, cfg, "fact_orders").schema.fields}
    return T.StructType([T.StructField(f.name, keys[f.name] if f.name in KEYS else f.dataType) for f in C.EVENTS.fields])


def silver_to_gold(spark: SparkSession, cfg: PipelineConfig) -> None:
    sv = lambda t: spark.read.parquet(cfg.p("silver", t))
    customers = K.scd2_current(sv("dim_customers"))
    items, products, payments = sv("fact_order_items"), sv("dim_products"), sv("fact_payments")
    translation = sv("dim_category_translation")
    processed_schema = T.StructType(event_schema(spark, cfg).fields + [T.StructField("customer_state", T.StringType()),
                                                        T.StructField("customer_city", T.StringType())])
    stream = read_optional(spark, cfg.p("stream", "processed"), processed_schema).select(*processed_schema.names).unionByName(
        read_optional(spark, cfg.p("stream", "late"), processed_schema).select(*processed_schema.names))
    values = LU.order_values(payments)
    unified = LU.valued_orders(LU.unify_orders(sv("fact_orders"), stream), values)
    # one materialisation: every gold table sees the same survivors and values
    MT.publish_swap(spark, unified, cfg.p("gold", "lambda_orders"), ["year", "month"], cluster_by=["order_id"])
    orders = spark.read.parquet(cfg.p("gold", "lambda_orders"))
    gold = {
        "gold_sales_by_category_time": (G.sales_by_category(items.drop("year", "month"), products, orders,
                                                            translation), ["year", "month"]),
        "gold_sales_by_payment": (G.sales_by_payment(payments, orders), ["payment_type"]),
        "gold_sales_by_region": (G.sales_by_region(orders, customers), None),
        "gold_customer_segmentation": (G.customer_segmentation(orders, customers, values, cfg.as_of), None),
        "gold_order_value_metrics": (G.order_value_metrics(orders, values), None),
    }
    if cfg.extra_gold:
        gold.update({
            "gold_customer_frequency": (GX.customer_frequency(orders, values, customers), None),
            "gold_revenue_by_region": (GX.revenue_by_region(orders, values, customers), ["customer_state"]),
            "gold_new_vs_returning": (GX.new_vs_returning(orders, values, customers), None),
            "gold_payment_performance": (GX.payment_performance(payments), None),
            "gold_product_profitability": (GX.product_profitability(items, products), None),
            "sales_obt": (GX.sales_obt(orders, values, items.drop("year", "month"), products, customers),
                          ["year", "month"]),
            "gold_top_products": (B.top_products_per_category(items.drop("year", "month"), products, orders),
                                  ["year"]),
            "gold_discount_impact": (B.discount_impact(items), None),
            "gold_price_vs_volume": (GX.price_vs_volume(items, products), None),
            "gold_co_purchase": (B.co_purchase_affinity(items, products), None),
        })
        weather = cfg.tables.weather(spark)
        if weather is not None:
            gold["gold_weather_impact"] = (GX.weather_impact(orders, values, weather), None)
        hourly = read_optional(spark, cfg.p("stream", "hourly_counts"), HOURLY_SCHEMA)
        gold["gold_demand_anomalies"] = (B.demand_anomalies(hourly), None)
    # order-grain tables grow with the data: range-cluster them on their
    # partition columns + order key so each partition gets few, large files.
    # Each table is published by write + row check + swap, so a failed or
    # interrupted run leaves the previous version readable.
    clustered = {"sales_obt": ["order_id"]}
    for name, (df, parts) in gold.items():
        MT.publish_swap(spark, df, cfg.p("gold", name), parts, cluster_by=clustered.get(name))
    cfg.results["gold_tables"] = sorted(gold)
    if cfg.catalog_database:
        tables = {name: cfg.p("gold", name) for name in gold}
        tables["dq_results"] = cfg.p("dq", "results")
        cfg.results["views"] = register_catalog(spark, tables, cfg.catalog_database)


def maintenance(spark: SparkSession, cfg: PipelineConfig) -> None:
    tables = {f"silver/{t}": cfg.p("silver", t) for t in MT.list_tables(spark, cfg.p("silver"))}
    for table in MT.list_tables(spark, cfg.p("silver")):
        MT.compact(spark, cfg.p("silver", table), cluster_by=CLUSTERED.get(table))
    raw = cfg.p("stream", "raw")
    if MT.path_exists(spark, raw):
        keys = ["is_valid", *jobs.RAW_PARTITIONS]
        old = MT.expired_folders(spark, raw, keys, cfg.retention_days, cfg.as_of).where("expired")
        cfg.results["expired_partitions"] = MT.delete_partitions(spark, raw, old, keys)
    write_table(MT.inventory(spark, tables), cfg.p("ops", "inventory"))


def _log_results(cfg: PipelineConfig, results: DataFrame) -> DataFrame:
    """Append rule results to the DQ log; return this batch read back, so the
    rules are computed once (by the write) and the gate reads a few rows."""
    batch = uuid.uuid4().hex
    tagged = results.withColumns({"run_date": F.lit(cfg.as_of).cast("date"), "batch_id": F.lit(batch)})
    write_table(tagged, cfg.p("dq", "results"), mode="append")
    return results.sparkSession.read.parquet(cfg.p("dq", "results")).filter(F.col("batch_id") == batch)


STAGE_FUNCS = {"raw_to_silver": raw_to_silver, "dq_audit": dq_audit, "speed_layer": speed_layer,
               "silver_to_gold": silver_to_gold, "maintenance": maintenance}


def run(spark: SparkSession, cfg: PipelineConfig, stages: list[str] | None = None) -> dict:
    for stage in stages or STAGES:
        STAGE_FUNCS[stage](spark, cfg)
    return cfg.results
