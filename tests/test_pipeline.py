import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.plans import pipeline as P
from strata.sources import testdata as D


def test_pipeline_end_to_end_and_scd2_rerun(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    D.event_payloads(spark, SF_SMALL).select("value").write.parquet(landing)
    cfg = P.PipelineConfig(SF_SMALL, os.path.join(tmp_dir, "lake"), "2024-01-01", payload_dir=landing,
                           catalog_database="strata_gold_test")
    res = P.run(spark, cfg)
    assert res["dq_passed"] in (True, False)
    lake = cfg.p
    assert spark.read.parquet(lake("gold", "gold_sales_by_category_time")).count() > 0
    assert spark.read.parquet(lake("stream", "hourly_counts")).count() > 0
    alerts = spark.read.parquet(lake("stream", "demand_alerts"))  # closed hours, silent ones too
    assert alerts.where("n_events > 0").count() == spark.read.parquet(lake("stream", "hourly_counts")).count()
    assert spark.read.parquet(lake("gold", "gold_demand_anomalies")).count() > 0
    assert ("event_date", "date") in spark.read.parquet(lake("stream", "processed")).dtypes
    late = P.read_optional(spark, lake("stream", "late"), "order_id long")  # one drain: no row came too late
    assert late.count() == res["late_rows_dropped"] == 0
    assert spark.read.parquet(lake("gold", "gold_top_products")).count() > 0
    orders = spark.read.parquet(lake("gold", "lambda_orders"))
    origins = {r.origin for r in orders.select("origin").distinct().collect()}
    assert origins == {"batch", "stream"}
    assert orders.groupBy("order_id").count().filter("count > 1").count() == 0
    from strata.streaming import jobs
    assert jobs.quarantine(spark, lake("stream", "raw")).count() > 0
    assert spark.read.parquet(lake("dq", "results")).count() > 0
    assert set(res["views"]) == {"v_sales_by_region", "v_sales_by_category", "v_payment_metrics",
                                 "v_dq_audit_summary"}
    cat = spark.sql("SELECT * FROM strata_gold_test.v_sales_by_category")
    assert cat.count() == spark.read.parquet(lake("gold", "gold_sales_by_category_time")).count()
    assert "otros" in {r[0] for r in cat.select("product_category_name_english").distinct().collect()}
    assert spark.table("strata_gold_test_silver.fact_orders").count() == \
        spark.read.parquet(lake("silver", "fact_orders")).count()
    pruned = spark.sql("SELECT * FROM strata_gold_test.v_payment_metrics WHERE payment_type = 'A'")
    assert "PartitionFilters: [isnotnull(payment_type" in pruned._jdf.queryExecution().executedPlan().toString()
    inv = {r.table_name: r for r in spark.read.parquet(lake("ops", "inventory")).collect()}
    assert inv["silver/fact_orders"].rows == spark.read.parquet(lake("silver", "fact_orders")).count()

    # re-running gold from the same silver reproduces every gold table exactly
    snap = {t: sorted(map(repr, spark.read.parquet(lake("gold", t)).collect()))
            for t in ["lambda_orders", "gold_customer_segmentation", "sales_obt", "gold_new_vs_returning"]}
    P.run(spark, cfg, ["silver_to_gold"])
    for t, rows in snap.items():
        assert sorted(map(repr, spark.read.parquet(lake("gold", t)).collect())) == rows, t

    # second delivery: SCD2 merge; a re-run of the same delivery changes nothing
    n0 = res["dim_customers_rows"]
    cfg2 = P.PipelineConfig(SF_SMALL, cfg.out_root, "2024-01-16", customer_updates=True)
    n1 = P.run(spark, cfg2, ["raw_to_silver"])["dim_customers_rows"]
    n2 = P.run(spark, cfg2, ["raw_to_silver"])["dim_customers_rows"]
    assert n1 > n0 and n2 == n1
    dim = spark.read.parquet(lake("silver", "dim_customers"))
    assert dim.filter("is_current").groupBy("customer_id").count().filter("count > 1").count() == 0
    assert dim.filter(~F.col("is_current")).count() > 0


def test_pipeline_backfill_replaces_only_its_partitions(spark, tmp_dir):
    import glob
    cfg = P.PipelineConfig(SF_SMALL, os.path.join(tmp_dir, "lake"), "2024-01-01")
    P.run(spark, cfg, ["raw_to_silver"])
    orders = spark.read.parquet(cfg.p("silver", "fact_orders"))
    items_n = spark.read.parquet(cfg.p("silver", "fact_order_items")).count()
    files = glob.glob(cfg.p("silver", "fact_orders", "**", "*.parquet"), recursive=True)
    outside = {f: os.path.getmtime(f) for f in files if "year=1997/month=3" not in f}
    inside = [f for f in files if "year=1997/month=3" in f]
    before = orders.count()
    bf = P.PipelineConfig(SF_SMALL, cfg.out_root, "2024-01-02", date_range=("1997-03-01", "1997-03-31"))
    P.run(spark, bf, ["raw_to_silver"])
    after = spark.read.parquet(cfg.p("silver", "fact_orders"))
    assert after.count() == before and spark.read.parquet(cfg.p("silver", "fact_order_items")).count() == items_n
    for f, m in outside.items():
        assert os.path.exists(f) and os.path.getmtime(f) == m
    assert inside and not any(os.path.exists(f) for f in inside)  # the range's files were replaced


def test_command_line(spark, tmp_dir, capsys):
    from strata.__main__ import main
    assert main(["list"]) == 0
    assert "gold_sales_by_category\tsql-checked" in capsys.readouterr().out
    out = os.path.join(tmp_dir, "q")
    assert main(["query", "gold_sales_by_region", "--sf-dir", SF_SMALL, "--out", out]) == 0
    assert spark.read.parquet(out).count() > 0
    lake = os.path.join(tmp_dir, "lake")
    assert main(["pipeline", "--sf-dir", SF_SMALL, "--out", lake, "--as-of", "2024-01-01",
                 "--stages", "raw_to_silver", "dq_audit"]) == 0
    assert spark.read.parquet(os.path.join(lake, "silver", "fact_orders")).count() > 0
