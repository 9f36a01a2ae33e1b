import datetime as dt
import os

from pyspark.sql import functions as F

from strata.operators import brief as B
from strata.operators import lambda_union as LU
from strata.operators import quality as Q
from strata.operators import silver as S
from strata.operators.dedup import dedup_latest
from strata.plans.writers import write_table
from strata.sources import contracts as C
from strata.sources import readers as R


def test_drop_null_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, b string, c string")
    assert S.drop_null_columns(df).columns == ["a", "c"]


def test_schema_check_and_enforcement(spark):
    df = spark.createDataFrame([("1", "x", "bad")], "order_id string, order_status string, extra string")
    diffs = {(r.expectation, r.column) for r in Q.schema_results(df, C.ORDERS, "orders", spark).collect()}
    assert ("schema_type", "order_id") in diffs and ("schema_missing", "customer_id") in diffs
    assert ("schema_unexpected", "extra") in diffs
    bad = spark.createDataFrame([("1",), ("x",)], "order_id string")
    out = C.enforce_schema(bad, C.ORDERS)
    assert out.schema == C.ORDERS and [r.order_id for r in out.collect()] == [1, None]
    assert C.cast_rejects(bad, C.ORDERS).count() == 1


def test_report_formats_percentages(spark):
    df = spark.createDataFrame([(1,), (None,), (None,), (4,)], "a int")
    r = Q.report(Q.run_rules(df, "t", [Q.NotNull("a", 0.6), Q.Unique("a")])).collect()
    obs = {x.expectation: x.observed for x in r}
    assert obs == {"not_be_null": "50.00%", "be_unique": "1"}


def test_external_table_write(spark, tmp_dir):
    path = os.path.join(tmp_dir, "ext")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    write_table(df, path, ["p"], table_name="strata_ext_test")
    assert spark.table("strata_ext_test").count() == 2 and os.path.isdir(os.path.join(path, "p=a"))
    spark.sql("DROP TABLE strata_ext_test")
    assert os.path.isdir(path)  # external: dropping the table keeps the data


def test_json_reader_quarantines_and_flattens(spark, tmp_dir):
    path = os.path.join(tmp_dir, "j")
    with open(os.path.join(tmp_dir, "j.json"), "w") as f:
        f.write('{"s": {"a": 1, "b": {"c": "x"}}}\n{"s": {"a": 2, \n')
    os.makedirs(path)
    os.rename(os.path.join(tmp_dir, "j.json"), os.path.join(path, "part.json"))
    schema = "s struct<a: int, b: struct<c: string>>"
    from pyspark.sql.types import _parse_datatype_string
    df = R.read_json(spark, path, _parse_datatype_string(schema))
    good, bad = R.split_corrupt(df)
    assert bad.count() == 1
    flat = R.flatten(good)
    assert flat.columns == ["s_a", "s_b_c"] and flat.first().s_b_c == "x"


# --- a key holding a third of all rows ---------------------------------------

def _hot_items(spark, n=3000):
    # order 7 holds a third of the rows; every other order has 1-3 items
    rows = []
    for i in range(n):
        order = 7 if i % 3 == 0 else 1000 + i // 3
        rows.append((order, i, 100 + i % 50, ["A", "B", "C", "D"][i % 4], i % 5 + 1))
    return spark.createDataFrame(rows, "order_id long, order_item_id int, product_id long, cat string, quantity int")


def test_hot_key_dedup_is_correct_and_limited_before_shuffle(spark):
    items = _hot_items(spark)
    doubled = items.unionByName(items.withColumn("quantity", F.col("quantity") + 10))
    out = dedup_latest(doubled, ["order_id", "order_item_id"], [F.col("quantity").desc()])
    assert out.count() == 3000 and out.agg(F.min("quantity")).first()[0] >= 11
    hot = dedup_latest(doubled, ["order_id"], ["order_item_id", F.col("quantity").desc()])
    assert hot.filter("order_id = 7").first().order_item_id == 0
    plan = hot._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange") or "WindowGroupLimit" in plan


def test_hot_key_co_purchase_matches_brute_force(spark):
    items = _hot_items(spark, 600)
    products = items.select("product_id", F.col("cat").alias("product_category_name")).dropDuplicates(["product_id"])
    got = {(r.product_id, r.co_category): r.n_orders
           for r in B.co_purchase_affinity(items.select("order_id", "product_id"), products).collect()}
    # brute force over all item pairs of each order (small fixture only)
    cat = {r.product_id: r.product_category_name for r in products.collect()}
    by_order = {}
    for r in items.collect():
        by_order.setdefault(r.order_id, []).append(r.product_id)
    want = {}
    for order, prods in by_order.items():
        seen = set()
        for p in prods:
            for q in prods:
                if cat[q] != cat[p] and (p, cat[q]) not in seen:
                    seen.add((p, cat[q]))
                    want[(p, cat[q])] = want.get((p, cat[q]), 0) + 1
    assert got == want


def test_hot_customer_lambda_and_new_vs_returning(spark):
    from strata.operators import gold_extra as GX
    t0 = dt.datetime(2024, 1, 1)
    orders = spark.createDataFrame(
        [(i, 5000 if i % 3 == 0 else i, "F", t0 + dt.timedelta(days=i % 60), 2024, 1 + (i % 60) // 31)
         for i in range(900)],
        "order_id long, customer_id long, order_status string, order_purchase_timestamp timestamp_ntz, "
        "year int, month int")
    customers = spark.createDataFrame([(i, i, "S") for i in [*range(900), 5000]],
                                      "customer_id long, customer_unique_id long, customer_state string")
    values = spark.createDataFrame([], "order_id long, order_value decimal(18,2)")
    u = LU.unify_orders(orders)
    nv = GX.new_vs_returning(u, values, customers).agg(F.sum("new_orders"), F.sum("returning_orders")).first()
    # 300 orders of the hot customer: one is new; the 600 others are all first orders
    assert tuple(nv) == (601, 299)


def test_cluster_conf_scales_with_input():
    from strata.session import cluster_conf
    big = cluster_conf(100 * 2**40, 8000)
    small = cluster_conf(10 * 2**30, 64)
    assert int(big["spark.sql.shuffle.partitions"]) == 102_400
    assert int(small["spark.sql.shuffle.partitions"]) == 192  # at least 3 per core
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
