"""Backfills lose nothing, interrupted publishes lose nothing, sessions keep their settings, histories keep their order."""

import os
import subprocess
import sys
from datetime import date, datetime

import pytest

from strata.operators import scd2 as K
from strata.operators.dedup import dedup_latest
from strata.plans import maintenance as MT
from strata.plans.writers import write_table
from strata.streaming import jobs

ORDERS = "order_id long, order_purchase_timestamp timestamp, order_status string, year int, month int"


def orders(spark, rows):
    return spark.createDataFrame([(i, t, s, t.year, t.month) for i, t, s in rows], ORDERS)


def test_backfill_of_part_of_a_month_keeps_the_rest(spark, tmp_dir):
    path = f"{tmp_dir}/orders"
    first = [(i, datetime(2024, 1 + i % 3, 1 + i % 28), "a") for i in range(90)]
    write_table(orders(spark, first), path, ["year", "month"])
    # order 3 moved from January to March 12th; order 7 left the range altogether
    second = [(i, t, "b") for i, t, _ in first if i not in (3, 7)] + [(3, datetime(2024, 3, 12), "b")]
    MT.backfill(orders(spark, second), path, "order_purchase_timestamp", "2024-03-10", "2024-03-15", ["year", "month"],
                keys=["order_id"])
    got = {r.order_id: r for r in spark.read.parquet(path).collect()}
    assert spark.read.parquet(path).count() == len(got) == 90
    for i, t, _ in first:
        inside = i == 3 or datetime(2024, 3, 10) <= t < datetime(2024, 3, 16)
        assert got[i].order_status == ("b" if inside else "a"), i
    assert (got[3].month, got[3].order_purchase_timestamp) == (3, datetime(2024, 3, 12))


def test_backfill_removes_a_partition_left_without_rows(spark, tmp_dir):
    path = f"{tmp_dir}/orders"
    write_table(orders(spark, [(1, datetime(2024, 1, 5), "a"), (2, datetime(2024, 2, 5), "a")]), path, ["year", "month"])
    MT.backfill(orders(spark, [(1, datetime(2024, 2, 7), "b")]), path, "order_purchase_timestamp", "2024-01-01",
                "2024-02-28", ["year", "month"], keys=["order_id"])
    assert [(r.order_id, r.month, r.order_status) for r in spark.read.parquet(path).collect()] == [(1, 2, "b")]


def test_interrupted_swap_is_recovered(spark, tmp_dir):
    path = f"{tmp_dir}/dim"
    spark.range(5).write.parquet(path)
    assert not MT.recover(spark, path)
    os.rename(path, path + ".__old_1234abcd")  # what a run that ended between the two renames leaves
    assert MT.recover(spark, path) and spark.read.parquet(path).count() == 5
    assert not MT.recover(spark, f"{tmp_dir}/never_there")


def test_older_delivery_is_refused(spark):
    cols = "customer_id long, state string"
    dim = K.scd2_initial(spark.createDataFrame([(1, "SP"), (2, "RJ")], cols), date(2024, 3, 1))
    older = spark.createDataFrame([(1, "MG")], cols)
    with pytest.raises(Exception, match="before the current version"):
        K.scd2_merge(dim, older, "customer_id", "2024-01-01").collect()
    later = K.scd2_merge(dim, older, "customer_id", "2024-04-01")
    assert sorted((r.customer_id, r.state, r.is_current) for r in later.collect()) == [
        (1, "MG", True), (1, "SP", False), (2, "RJ", True)]
    # keys the old delivery does not hold are no reason to refuse it
    assert K.scd2_merge(dim, spark.createDataFrame([(9, "BA")], cols), "customer_id", "2024-01-01").count() == 3


def test_tied_rows_have_one_survivor_in_any_order(spark):
    rows = [(1, "name", f"b{i}", i % 2) for i in range(6)]
    got = set()
    for shift in range(6):
        df = spark.createDataFrame(rows[shift:] + rows[:shift], "id long, name string, brand string, size int")
        got |= {tuple(r) for r in dedup_latest(df.repartition(3), ["id"], ["name"], total=True).collect()}
    assert got == {(1, "name", "b0", 0)}


def test_status_changes_of_an_order_all_survive_the_stream(spark, tmp_dir):
    schema = jobs.RAW_SCHEMA
    at = datetime(2024, 1, 1, 10)
    rows = [(1, 5, s, at.replace(minute=m), "10.00", True, at.replace(minute=m)) for m, s in enumerate(["created", "shipped", "delivered"])]
    rows.append(rows[1])  # one delivery twice
    raw = spark.createDataFrame([], schema)
    values = [dict(zip(["order_id", "customer_id", "order_status", "event_timestamp", "order_value", "is_valid", "arrived_at"], r)) for r in rows]
    fields = {f.name: f.dataType for f in schema.fields}
    df = spark.createDataFrame([tuple(v.get(n) for n in ("order_id", "customer_id", "order_status", "event_timestamp",
                                                          "order_value", "is_valid", "arrived_at")) for v in values],
                               "order_id long, customer_id long, order_status string, event_timestamp timestamp, "
                               "order_value string, is_valid boolean, arrived_at timestamp")
    df = df.select(*[df[n].cast(t).alias(n) if n in df.columns else None for n, t in fields.items()])
    df.write.parquet(f"{tmp_dir}/raw")
    events = spark.readStream.schema(raw.schema).parquet(f"{tmp_dir}/raw")
    customers = spark.createDataFrame([(5, "SP", "x")], "customer_id long, customer_state string, customer_city string")
    jobs.process_job(events, customers, f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/out").collect()
    assert sorted(r.order_status for r in got) == ["created", "delivered", "shipped"]
    assert not any(r.is_late for r in got)  # they arrived on time, however late they are drained


def test_running_session_keeps_its_settings():
    code = """
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[1]").config("spark.sql.shuffle.partitions", "4000").config(
    "spark.sql.session.timeZone", "America/Sao_Paulo").config("spark.ui.enabled", "false").getOrCreate()
from strata.session import get_session
t = get_session()
assert t is s or t.sparkContext is s.sparkContext
assert t.conf.get("spark.sql.shuffle.partitions") == "4000"
assert t.conf.get("spark.sql.session.timeZone") == "America/Sao_Paulo"
print("kept")
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    got = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=240)
    assert "kept" in got.stdout, got.stderr[-2000:]


def test_backfill_scans_only_touched_partitions(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/orders"
    rows = [(i, datetime(2024, 1 + i % 12, 1 + i % 28), "a") for i in range(400)]
    write_table(orders(spark, rows), path, ["year", "month"])
    plans, real = [], MT.write_table

    def spy(df, p, *a, **k):
        if p.endswith("/rows"):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, p, *a, **k)
    monkeypatch.setattr(MT, "write_table", spy)
    MT.backfill(orders(spark, [(i, t, "b") for i, t, _ in rows]), path, "order_purchase_timestamp", "2024-03-10", "2024-03-15",
                ["year", "month"])
    scan = [ln for ln in plans[0].splitlines() if "FileScan parquet" in ln]
    assert len(scan) == 1 and "(year" in scan[0].split("PartitionFilters")[1] and "= 3" in scan[0].split("PartitionFilters")[1]
    assert not any(f"= {m})" in scan[0] for m in (1, 2, 4, 12))
    got = spark.read.parquet(path)
    assert got.count() == 400 and got.where("order_status = 'b'").select("month").distinct().collect()[0].month == 3


@pytest.mark.parametrize("stop", ["overwrite", "delete"])
def test_interrupted_replace_is_finished(spark, tmp_dir, monkeypatch, stop):
    path = f"{tmp_dir}/orders"
    write_table(orders(spark, [(1, datetime(2024, 1, 5), "a"), (2, datetime(2024, 2, 5), "a"), (3, datetime(2024, 5, 5), "a")]), path,
                ["year", "month"])
    new = orders(spark, [(1, datetime(2024, 2, 7), "b")])
    args = (new, path, "order_purchase_timestamp", "2024-01-01", "2024-02-28", ["year", "month"])
    real_write, real_delete = MT.write_table, MT.delete_partitions

    def fail(*a, **k):
        raise KeyboardInterrupt
    monkeypatch.setattr(MT, "write_table", lambda df, p, *a, **k: fail() if stop == "overwrite" and p == path else real_write(df, p, *a, **k))
    if stop == "delete":
        monkeypatch.setattr(MT, "delete_partitions", fail)
    with pytest.raises(KeyboardInterrupt):
        MT.backfill(*args, keys=["order_id"])
    monkeypatch.setattr(MT, "write_table", real_write)
    monkeypatch.setattr(MT, "delete_partitions", real_delete)
    assert MT.finish_replace(spark, path, ["year", "month"]) == 1
    got = sorted((r.order_id, r.month, r.order_status) for r in spark.read.parquet(path).collect())
    assert got == [(1, 2, "b"), (3, 5, "a")] and os.listdir(tmp_dir) == ["orders"]


def test_retention_of_raw_events_reads_listings_only(spark, tmp_dir):
    path = f"{tmp_dir}/raw"
    rows = [(i, 2023 + i % 2, 1 + i % 3, None if i == 5 else 7, i % 24) for i in range(60)]
    write_table(spark.createDataFrame(rows, "id long, year int, month int, day int, hour int"), path, ["year", "month", "day", "hour"])
    found = MT.expired_folders(spark, path, ["year", "month", "day", "hour"], 30, "2024-03-01")
    assert "FileScan parquet" not in found._jdf.queryExecution().executedPlan().toString()
    removed = MT.delete_partitions(spark, path, found.where("expired"), ["year", "month", "day", "hour"])
    left = spark.read.parquet(path)
    assert removed and {(r.year, r.month, r.day) for r in left.collect()} == {
        (y, m, d) for _, y, m, d, _ in rows if d is None or date(y, m, d) >= date(2024, 1, 31)}
