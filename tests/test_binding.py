"""Raw tables bound by contract: text keys end to end, renamed columns, carried columns, rejects."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.plans import pipeline as P
from strata.plans.q_sources import text_keyed_tables
from strata.sources import testdata as D
from strata.sources.binding import Binding, BoundTables, contract_of


def test_text_keyed_folders_run_end_to_end(spark, tmp_dir):
    sources = text_keyed_tables(spark, SF_SMALL, os.path.join(tmp_dir, "raw"))
    assert len(os.listdir(os.path.join(tmp_dir, "raw"))) == 8
    landing = os.path.join(tmp_dir, "landing")
    D.event_payloads(spark, SF_SMALL).select(
        F.regexp_replace("value", r'"(order|customer)_id":(\d+)', r'"$1_id":"$1-$2"').alias("value")).write.parquet(landing)
    cfg = P.PipelineConfig("", os.path.join(tmp_dir, "lake"), "2024-01-01", payload_dir=landing, sources=sources, halt_on_dq=False)
    P.run(spark, cfg, ["raw_to_silver", "dq_audit", "speed_layer", "silver_to_gold"])
    silver = lambda t: spark.read.parquet(cfg.p("silver", t))

    orders = silver("fact_orders")
    kinds = dict(orders.dtypes)
    assert kinds["order_id"] == kinds["customer_id"] == "string"
    for c in ("order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date", "updated_at"):
        assert kinds[c] == "timestamp_ntz", c
    raw = D.raw_orders(spark, SF_SMALL)
    assert orders.count() == raw.select("order_id").distinct().count()
    assert orders.where("order_status = 'created'").count() == 0  # the older versions lost
    assert "product_weight_g" in silver("dim_products").columns and "product_name_length" not in silver("dim_products").columns
    assert silver("dim_sellers").select("seller_zip_code_prefix").first()[0][0] == "0"  # text keeps its zeros

    bad = spark.read.parquet(cfg.p("dq", "rejects"))
    n = D.raw_order_items(spark, SF_SMALL).where("order_id % 50 = 0 and order_item_id = 1").count()
    assert n > 0 and bad.count() == n
    assert {(r.table_name, *r.rejected_columns) for r in bad.collect()} == {("order_items", "price")}
    log = spark.read.parquet(cfg.p("dq", "results"))
    casts = {r.column: (r.status, r.observed_value) for r in log.where("table_name = 'raw_order_items'").collect()}
    assert casts["price"] == ("FAIL", float(n))
    audit = {(r.table_name, r.expectation, r.column): r.status for r in log.collect()}
    lost = silver("fact_order_items").where("price is null").count()
    assert lost > 0 and audit[("fact_order_items", "not_be_null", "price")] == "FAIL"
    assert audit[("fact_payments", "not_be_null", "payment_value")] == "PASS"
    assert audit[("fact_orders", "schema_match", "*")] == "PASS"

    lam = spark.read.parquet(cfg.p("gold", "lambda_orders"))
    assert {r[0] for r in lam.select("origin").distinct().collect()} == {"batch", "stream"}
    assert dict(lam.dtypes)["order_id"] == "string"
    assert lam.where("origin = 'stream' and order_id not like 'order-%'").count() == 0
    units = spark.read.parquet(cfg.p("gold", "gold_top_products")).agg(F.sum("units")).first()[0]
    assert units and units > 0  # the default quantity


def test_binding_reads_by_contract(spark, tmp_dir):
    path = os.path.join(tmp_dir, "o.csv")
    spark.createDataFrame([("a1", "x", "2024-01-02 03:04:05", "junk"), (None, "y", "never", None)],
                          "id string, cust string, ts string, extra string").write.option("header", True).csv(path)
    tables = BoundTables.from_json('{"orders": {"path": "%s", "fmt": "csv", "options": {"header": "true"}, '
                                   '"columns": {"order_id": "id", "customer_id": "cust", "order_purchase_timestamp": "ts"}, '
                                   '"defaults": {"order_status": "open"}}}' % path)
    df = tables.read(spark, "orders")
    assert df.columns == ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_priority"]
    rows = {r.customer_id: r for r in df.collect()}
    assert rows["x"].order_id == "a1" and rows["x"].order_purchase_timestamp == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert rows["x"].order_status == "open" and rows["y"].order_purchase_timestamp is None
    bad = tables.rejects(spark, "orders").collect()
    assert [(r.rejected_columns, "never" in r.payload) for r in bad] == [(["order_purchase_timestamp"], True)]
    assert tables.read(spark, "products").count() == 0 and tables.rejects(spark, "products") is None
    assert tables.weather(spark) is None


def test_keys_keep_their_type(spark):
    longs = spark.createDataFrame([(1, 2)], "order_id long, customer_id int")
    kinds = {f.name: f.dataType.simpleString() for f in contract_of("orders", longs).fields}
    assert (kinds["order_id"], kinds["customer_id"]) == ("bigint", "int")
    odd = spark.createDataFrame([(1.5,)], "order_id double")
    assert contract_of("orders", odd)["order_id"].dataType.simpleString() == "bigint"


def test_wrong_bindings_are_named(spark, tmp_dir):
    spark.range(1).write.parquet(os.path.join(tmp_dir, "t"))
    with pytest.raises(ValueError, match="no such raw table: orderz"):
        BoundTables({"orderz": Binding("x")})
    with pytest.raises(ValueError, match="no column nope"):
        Binding(os.path.join(tmp_dir, "t"), {"order_id": "nope"}).read(spark)
