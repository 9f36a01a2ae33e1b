"""Raw items and payments reach silver with no exchange beyond what their dedup and layout need."""

import datetime
import random
from decimal import Decimal

from conftest import SF_SMALL
from strata.operators import gold as G
from strata.operators import lambda_union as LU
from strata.operators import silver as S
from strata.plans import pipeline as P

ITEMS = "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp_ntz, price decimal(18,2)"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_items_by_order_equals_dedup_then_join(spark):
    rng = random.Random(8)
    day = datetime.datetime(2024, 1, 1)
    rows = [(rng.choice([None, "o1", "o2", "o3", "o9"]), rng.choice([None, 1, 2]), f"p{rng.randrange(3)}", rng.choice([None, "s1"]),
             rng.choice([None, day, day + datetime.timedelta(1)]), None) for _ in range(200)]
    items = spark.createDataFrame(rows, ITEMS)
    orders = spark.createDataFrame([("o1", 2024, 1), ("o2", 2023, 12), ("o3", None, None), (None, 2020, 5)], "order_id string, year int, month int")
    got = S.items_by_order(items, orders, total=True)
    want = S.items_with_order_partition(S.clean_order_items(items, total=True), orders)
    assert got.columns == want.columns and rows_of(got) == rows_of(want) and got.count() == 15


def test_items_are_exchanged_once_for_dedup_and_join(spark, tmp_dir):
    rows = [("o1", 1, "p", "s", None, None)]
    spark.createDataFrame(rows, ITEMS).write.parquet(f"{tmp_dir}/items")
    spark.createDataFrame([("o1", 2024, 1)], "order_id string, year int, month int").write.parquet(f"{tmp_dir}/orders")
    items, orders = (spark.read.parquet(f"{tmp_dir}/{n}") for n in ("items", "orders"))
    plan = S.items_by_order(items, orders.hint("merge"), total=True)._jdf.queryExecution().executedPlan().toString()
    # by order: the items, the orders; items of no order apart, reduced before they are sent
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") == 3
    assert "isnull(order_id" in plan and "Partial" in plan


def test_payments_are_written_from_their_dedup(spark, tmp_dir, monkeypatch):
    given = {}
    write = P.write_table

    def record(df, path, *args, **kwargs):
        given[path.rsplit("/", 1)[-1]] = kwargs
        write(df, path, *args, **kwargs)

    monkeypatch.setattr(P, "write_table", record)
    cfg = P.PipelineConfig(SF_SMALL, f"{tmp_dir}/lake", "2024-01-01", extra_gold=False)
    P.run(spark, cfg, ["raw_to_silver"])
    assert given["fact_payments"].get("cluster_by") is None and given["fact_orders"]["cluster_by"] == ["order_id"]
    silver = spark.read.parquet(cfg.p("silver", "fact_payments"))
    want = S.clean_payments(cfg.tables.read(spark, "payments"), total=True)
    assert rows_of(silver.select(*want.columns)) == rows_of(want)


def test_order_value_metrics_take_published_values_as_they_are(spark):
    schema = "order_id long, year int, month int, order_value decimal(18,2)"
    orders = spark.createDataFrame([(1, 2024, 1, None), (2, 2024, 1, Decimal("7.00")), (3, 2024, 2, None)], schema)
    values = spark.createDataFrame([(1, Decimal("5.00"))], "order_id long, order_value decimal(18,2)")
    published = LU.valued_orders(orders, values)
    metrics = G.order_value_metrics(spark.createDataFrame(published.collect(), published.schema), values)
    assert "Join" not in metrics._jdf.queryExecution().optimizedPlan().toString()
    assert rows_of(metrics) == rows_of(G.order_value_metrics(orders, values))
