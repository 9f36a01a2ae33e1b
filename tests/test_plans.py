"""Plan-shape assertions: what is broadcast, what is pruned, what is pushed down."""

import __spark_entry__ as E
from conftest import SF_SMALL
from test_skew import conf

Q = E.queries()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_bounded_sides_are_broadcast_when_auto_broadcast_is_off(spark):
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        weather = _plan(Q["gold_weather_impact"](spark, SF_SMALL))
        assert weather.count("BroadcastExchange") == 1  # the calendar-hour profile (≤ 8,784 rows)
        for name in ["gold_sales_by_category", "gold_customer_segmentation", "sales_obt", "co_purchase_pairs",
                     "scd2_point_in_time_join", "stream_enriched", "dq_referential"]:
            assert "BroadcastExchange" not in _plan(Q[name](spark, SF_SMALL)), name


def test_scans_read_only_needed_columns(spark):
    plan = _plan(Q["gold_sales_by_category"](spark, SF_SMALL))
    line = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "lineitem" in ln][0]
    for unused in ("l_tax", "l_discount", "l_linestatus", "l_quantity"):
        assert unused not in line
    events = [ln for ln in _plan(Q["speed_filter"](spark, SF_SMALL)).splitlines()
              if "FileScan parquet" in ln and "events" in ln]
    assert events and all("props" not in ln for ln in events)


def test_speed_filter_reaches_the_raw_table_scan(spark, tmp_dir):
    """In the pipeline the speed filter reads the parsed raw table (Parquet),
    where it becomes a scan filter."""
    import os

    from strata.streaming import speed
    path = os.path.join(tmp_dir, "raw")
    spark.createDataFrame([(1, 1, "x", 2.0), (2, 1, None, 3.0), (3, 1, "y", -1.0)],
                          "order_id long, customer_id long, order_status string, order_value double") \
        .write.parquet(path)
    df = speed.speed_filter(spark.read.parquet(path))
    plan = _plan(df)
    assert "GreaterThan(order_value,0.0)" in plan and "IsNotNull(order_status)" in plan
    assert [r.order_id for r in df.collect()] == [1]
