"""Registered maintenance and serving queries."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import functions as F

from ..operators import gold as G
from ..session import scratch_path
from ..streaming import speed
from . import maintenance as MT
from . import oracle as O
from .layers import Layers
from .q_quality import _results
from .q_stream import _VALID_EVENTS, valid_events
from .registry import AS_OF, REGISTRY, publish, query
from .serving import VIEW_SQL, register_views
from .writers import write_table

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Backfill range, increment window, retention and freshness reference.
BACKFILL = ("1997-03-01", "1997-05-31")
INCREMENT = ("1998-01-01 00:00:00", "1998-06-30 00:00:00")
UPSERT_FROM_YEAR = 2001
RETENTION_DAYS = 20
FRESHNESS_AS_OF = "2027-01-01 00:00:00"

_REGION = """SELECT c.customer_state, o.year, o.month, count(o.order_id) AS total_orders
             FROM {src} o JOIN cur_customers c ON o.customer_id = c.customer_id {where}
             GROUP BY c.customer_state, o.year, o.month"""


@query("upsert_gold", O.sql(f"""
    WITH t AS ({_REGION.format(src="s_orders", where="")}),
    s AS ({_REGION.format(src="unified", where=f"WHERE o.year >= {UPSERT_FROM_YEAR}")})
    SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.customer_state = t.customer_state
                                      AND s.year = t.year AND s.month = t.month)
    UNION ALL SELECT * FROM s""", "s_orders", "unified", "cur_customers"))
def q_upsert_gold(spark, sf):
    L = Layers(spark, sf)
    target = G.sales_by_region(L.orders, L.customers)
    source = G.sales_by_region(L.unified_orders.filter(F.col("year") >= UPSERT_FROM_YEAR), L.customers)
    return MT.upsert(target, source, ["customer_state", "year", "month"])


@query("backfill_slice", O.sql(f"""
    SELECT p.product_category_name, o.year, o.month, CAST(SUM(i.price) AS DOUBLE) AS total_revenue,
           COUNT(i.order_item_id) AS total_items_sold
    FROM s_items i JOIN s_products p ON i.product_id = p.product_id
    JOIN (SELECT * FROM s_orders WHERE order_purchase_timestamp >= DATE '{BACKFILL[0]}'
          AND order_purchase_timestamp < DATE '{BACKFILL[1]}' + INTERVAL 1 DAY) o ON i.order_id = o.order_id
    GROUP BY 1, 2, 3""", "s_items", "s_products", "s_orders"))
def q_backfill_slice(spark, sf):
    L = Layers(spark, sf)
    sliced = MT.date_slice(L.orders, "order_purchase_timestamp", *BACKFILL)
    return G.sales_by_category(L.items, L.products, sliced)


@query("incremental_slice", O.sql(f"""
    SELECT order_id, payment_sequential, payment_type, payment_installments,
           CAST(payment_value AS DOUBLE) AS payment_value, paid_at
    FROM s_payments WHERE paid_at > TIMESTAMP '{INCREMENT[0]}' AND paid_at <= TIMESTAMP '{INCREMENT[1]}'""",
                                  "s_payments"))
def q_incremental_slice(spark, sf):
    return publish(MT.incremental_slice(Layers(spark, sf).payments, "paid_at", *INCREMENT))


@query("compaction_counts", O.sql("SELECT year, count(*) AS n_rows FROM s_orders GROUP BY year", "s_orders"))
def q_compaction_counts(spark, sf):
    """Write silver orders as many small files, compact them, read back counts.

    Runs eagerly (it is a maintenance job): the table lives under the shared
    checkpoint folder, in a fresh sub-folder per call."""
    path = scratch_path(spark, "compaction", uuid.uuid4().hex)
    write_table(Layers(spark, sf).orders.repartition(16), path, ["year"])  # up to 16 files per partition
    MT.compact(spark, path, ["year"], cluster_by=["order_id"])
    return spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"))


@query("backfill_partial_month", O.sql("""
    SELECT year, month, count(*) AS n_orders, count(DISTINCT order_id) AS n_distinct FROM s_orders
    GROUP BY year, month""", "s_orders"))
def q_backfill_partial_month(spark, sf):
    """Write silver orders, backfill six days in the middle of a month, count per month: nothing lost or doubled.

    Runs eagerly, as a backfill does, on a table under the shared checkpoint folder."""
    path = scratch_path(spark, "backfill", uuid.uuid4().hex)
    orders = Layers(spark, sf).orders
    write_table(orders, path, ["year", "month"])
    MT.backfill(orders, path, "order_purchase_timestamp", "1997-03-10", "1997-03-15", ["year", "month"],
                keys=["order_id"])
    return spark.read.schema(orders.schema).parquet(path).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count_distinct("order_id").alias("n_distinct"))


def _table_paths(sf):
    return {t: f"{sf.rstrip('/')}/{t}.parquet" for t in TABLES}


@query("file_inventory", None)
def q_file_inventory(spark, sf):
    return MT.inventory(spark, _table_paths(sf))


_ROWS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES)


@query("inventory_rows", f"SELECT * FROM ({_ROWS}) t UNION ALL SELECT 'weather_raw', 0")
def q_inventory_rows(spark, sf):
    """Rows per table from the files' footers, against counted rows; a table that was never delivered has none (M3, M4)."""
    paths = _table_paths(sf) | {"weather_raw": f"{sf.rstrip('/')}/weather_raw.parquet"}
    return MT.inventory(spark, paths).select("table_name", F.col("rows").alias("n_rows"))


@query("freshness", None)
def q_freshness(spark, sf):
    return MT.freshness(spark, _table_paths(sf), FRESHNESS_AS_OF)


@query("readiness", None)
def q_readiness(spark, sf):
    paths = _table_paths(sf)
    paths["weather_raw"] = f"{sf.rstrip('/')}/weather_raw.parquet"  # never delivered: not ready
    return MT.readiness(spark, paths)


_CUTOFF = (date.fromisoformat(AS_OF) - timedelta(days=RETENTION_DAYS)).isoformat()


@query("expired_partitions", O.sql(f"""
    SELECT CAST(year(event_timestamp) AS INTEGER) AS year, CAST(month(event_timestamp) AS INTEGER) AS month,
           CAST(day(event_timestamp) AS INTEGER) AS day, count(*) AS n_rows,
           min(CAST(event_timestamp AS DATE)) < DATE '{_CUTOFF}' AS expired
    FROM ({_VALID_EVENTS}) v GROUP BY 1, 2, 3""", "valid_events"))
def q_expired_partitions(spark, sf):
    ev = speed.hour_partition_cols(valid_events(spark, sf))
    return MT.expired_partitions(ev, ["year", "month", "day"], F.to_date("event_timestamp"), RETENTION_DAYS, AS_OF)


# ---------------------------------------------------------------- serving views

def _serving(spark, sf, view):
    """The rows of one serving view: only the base table that it reads is planned and registered."""
    L = Layers(spark, sf)
    base = VIEW_SQL[view][0]
    tables = {
        "gold_sales_by_region": lambda: G.sales_by_region(L.unified_orders, L.customers),
        "gold_sales_by_category": lambda: G.sales_by_category(L.items, L.products, L.unified_orders, L.translation),
        "gold_sales_by_payment": lambda: G.sales_by_payment(L.payments, L.unified_orders),
        "dq_results_log": lambda: _results(spark, sf, ["not_null", "unique", "between", "exists"]),
    }
    register_views(spark, {base: tables[base]()}, [view])
    return spark.sql(f"SELECT * FROM {view}")


@query("view_sales_by_region", O.sql(_REGION.format(src="unified", where=""), "unified", "cur_customers"))
def q_view_region(spark, sf):
    return _serving(spark, sf, "v_sales_by_region")


@query("view_sales_by_category", O.sql("""
    SELECT COALESCE(t.product_category_name_english, 'otros') AS product_category_name_english, o.year, o.month,
           CAST(SUM(i.price) AS DOUBLE) AS total_revenue, COUNT(i.order_item_id) AS total_items_sold
    FROM s_items i JOIN s_products p ON i.product_id = p.product_id
    JOIN unified o ON i.order_id = o.order_id
    LEFT JOIN translation t ON p.product_category_name = t.product_category_name
    GROUP BY 1, o.year, o.month""",
                                       "s_items", "s_products", "unified", "translation"))
def q_view_category(spark, sf):
    return _serving(spark, sf, "v_sales_by_category")


@query("view_payment_metrics", O.sql("""
    SELECT p.payment_type, o.year, o.month, CAST(SUM(p.payment_value) AS DOUBLE) AS total_revenue,
           COUNT(p.order_id) AS total_transactions
    FROM s_payments p JOIN unified o ON p.order_id = o.order_id
    GROUP BY p.payment_type, o.year, o.month""", "s_payments", "unified"))
def q_view_payment(spark, sf):
    return _serving(spark, sf, "v_payment_metrics")


@query("view_file_latency", None)
def q_view_latency(spark, sf):
    MT.freshness(spark, _table_paths(sf), FRESHNESS_AS_OF).createOrReplaceTempView("pipeline_file_freshness")
    register_views(spark, {}, ["v_pipeline_latency"])
    return spark.sql("SELECT * FROM v_pipeline_latency")


@query("view_dq_audit_summary", REGISTRY["dq_summary"][1])
def q_view_dq(spark, sf):
    return _serving(spark, sf, "v_dq_audit_summary")



# ---------------------------------------------------------------- JSON source, preview

WEATHER_COLD_BELOW = 40.0  # fixed value: hours colder than this are written as damaged lines


@query("weather_json_ingest", O.sql(f"""
    SELECT date_trunc('hour', ts) AS obs_hour,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS temperature, count(*) AS readings
    FROM events GROUP BY 1
    HAVING CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) >= {WEATHER_COLD_BELOW}"""))
def q_weather_json(spark, sf):
    """Weather history as nested JSON lines (damaged lines included), read back
    with a declared schema in PERMISSIVE mode, quarantined and flattened (S7, P3)."""
    from pyspark.sql import types as T

    from ..sources import readers as R
    from ..sources import testdata as D
    path = scratch_path(spark, "weather_json", uuid.uuid4().hex)
    w = D.weather_hourly(spark, sf)
    line = F.to_json(F.struct(F.struct("obs_hour", F.struct("temperature", "readings").alias("reading"))
                              .alias("station")))
    damaged = F.substring(line, 1, (F.length(line) / 2).cast("int"))
    w.select(F.when(F.col("temperature") < WEATHER_COLD_BELOW, damaged).otherwise(line).alias("value")) \
        .write.text(path)
    schema = T.StructType([T.StructField("station", T.StructType([
        T.StructField("obs_hour", T.TimestampType()),
        T.StructField("reading", T.StructType([T.StructField("temperature", T.DoubleType()),
                                               T.StructField("readings", T.LongType())]))]))])
    good, _bad = R.split_corrupt(R.read_json(spark, path, schema))
    flat = R.flatten(good)
    return flat.select(F.col("station_obs_hour").alias("obs_hour"),
                       F.col("station_reading_temperature").alias("temperature"),
                       F.col("station_reading_readings").alias("readings"))


@query("row_preview", O.sql("""
    SELECT * FROM (SELECT order_id, customer_id, order_status, order_purchase_timestamp, year, month, origin,
                          CAST(final_order_value AS DOUBLE) AS final_order_value
                   FROM valued) v ORDER BY order_id LIMIT 10""", "valued"))
def q_row_preview(spark, sf):
    """First rows of the lambda order table by key (N2): a top-k, so each task
    keeps only its 10 smallest keys (TakeOrderedAndProject), no global sort."""
    from ..operators import lambda_union as LU
    L = Layers(spark, sf)
    v = LU.valued_orders(L.unified_orders, L.order_values)
    return publish(v.select("order_id", "customer_id", "order_status", "order_purchase_timestamp", "year", "month",
                            "origin", "final_order_value").orderBy("order_id").limit(10))


@query("published_sales_by_category", O.sql("""
    SELECT p.product_category_name, o.year, o.month, CAST(SUM(i.price) AS DOUBLE) AS total_revenue,
           COUNT(i.order_item_id) AS total_items_sold
    FROM s_items i JOIN s_products p ON i.product_id = p.product_id
    JOIN s_orders o ON i.order_id = o.order_id
    GROUP BY p.product_category_name, o.year, o.month""", "s_items", "s_products", "s_orders"))
def q_published_sales_by_category(spark, sf):
    """The production path: raw → silver → gold written as tables (no stream
    lane), then the published gold table read back. Runs the two batch
    stages when called, into a fresh folder under the checkpoint folder."""
    from . import pipeline as P
    cfg = P.PipelineConfig(sf, scratch_path(spark, "pipeline", uuid.uuid4().hex), AS_OF, extra_gold=False)
    P.run(spark, cfg, ["raw_to_silver", "silver_to_gold"])
    return spark.read.parquet(cfg.p("gold", "gold_sales_by_category_time")).select(
        "product_category_name", "year", "month", "total_revenue", "total_items_sold")
