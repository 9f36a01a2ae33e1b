import datetime as dt

from pyspark.sql import functions as F

from strata.operators import gold as G
from strata.operators import gold_extra as GX
from strata.operators import lambda_union as LU

T0 = dt.datetime(2024, 1, 10)
ORD = "order_id long, customer_id long, order_status string, order_purchase_timestamp timestamp_ntz, year int, month int"


def _orders(spark):
    rows = [(1, 10, "F", T0, 2024, 1), (2, 10, "F", T0 + dt.timedelta(days=40), 2024, 2),
            (3, 11, "O", T0, 2024, 1), (4, 12, "O", T0, 2024, 1)]
    return LU.unify_orders(spark.createDataFrame(rows, ORD))


def _payments(spark):
    rows = [(1, 1, "A", 2, "10.50"), (1, 2, "B", 1, "4.50"), (2, 1, "A", 1, "20.00"), (3, 1, "A", 3, "1.00")]
    return spark.createDataFrame(rows, "order_id long, payment_sequential int, payment_type string, "
                                       "payment_installments int, v string") \
        .withColumn("payment_value", F.col("v").cast("decimal(18,2)")).drop("v")


def _customers(spark):
    return spark.createDataFrame([(10, 100, "SP", "c1", True), (11, 100, "RJ", "c2", True),
                                  (12, 101, "SP", "c1", True), (12, 101, "MG", "c3", False)],
                                 "customer_id long, customer_unique_id long, customer_state string, "
                                 "customer_city string, is_current boolean")


def test_sales_by_payment_counts_payment_rows(spark):
    out = {(r.payment_type, r.month): (r.total_revenue, r.total_transactions)
           for r in G.sales_by_payment(_payments(spark), _orders(spark)).collect()}
    assert out == {("A", 1): (11.5, 2), ("B", 1): (4.5, 1), ("A", 2): (20.0, 1)}


def test_order_value_metrics_unpaid_orders_count_as_zero(spark):
    vals = LU.order_values(_payments(spark))
    out = {r.month: r for r in G.order_value_metrics(_orders(spark), vals).collect()}
    jan = out[1]
    assert jan.total_orders == 3 and jan.min_ticket == 0.0 and jan.max_ticket == 15.0
    assert abs(jan.average_ticket - 16.0 / 3) < 1e-12


def test_segmentation_by_person_with_recency(spark):
    vals = LU.order_values(_payments(spark))
    out = {r.customer_unique_id: r for r in
           G.customer_segmentation(_orders(spark), _customers(spark), vals, "2024-03-01").collect()}
    p = out[100]  # customers 10 and 11 are one person
    assert (p.frequency, p.monetary) == (3, 36.0)
    assert p.recency_days == (dt.date(2024, 3, 1) - (T0 + dt.timedelta(days=40)).date()).days
    assert out[101].frequency == 1  # only the current version of customer 12 joins


def test_sales_by_region_uses_current_rows_only(spark):
    out = {(r.customer_state, r.month): r.total_orders
           for r in G.sales_by_region(_orders(spark), _customers(spark)).collect()}
    assert out == {("SP", 1): 2, ("SP", 2): 1, ("RJ", 1): 1}


def test_sales_by_category_null_category_is_a_group(spark):
    items = spark.createDataFrame([(1, 1, 5, "2.00"), (1, 2, 6, "3.00"), (3, 1, 7, "1.00")],
                                  "order_id long, order_item_id int, product_id long, p string") \
        .withColumn("price", F.col("p").cast("decimal(18,2)")).drop("p")
    products = spark.createDataFrame([(5, "X"), (6, None), (7, "X")], "product_id long, product_category_name string")
    out = {(r.product_category_name, r.month): (r.total_revenue, r.total_items_sold)
           for r in G.sales_by_category(items, products, _orders(spark)).collect()}
    assert out == {("X", 1): (3.0, 2), (None, 1): (3.0, 1)}


def test_new_vs_returning_and_frequency(spark):
    vals = LU.order_values(_payments(spark))
    nv = {r.month: r for r in GX.new_vs_returning(_orders(spark), vals, _customers(spark)).collect()}
    # person 100: order 1 (Jan, first) and 3 (Jan, same time, higher id → returning), order 2 (Feb, returning)
    assert (nv[1].new_orders, nv[1].returning_orders) == (2, 1)
    assert (nv[2].new_orders, nv[2].returning_orders) == (0, 1)
    fr = {r.customer_unique_id: r for r in GX.customer_frequency(_orders(spark), vals, _customers(spark)).collect()}
    assert (fr[100].n_orders, fr[100].active_months, fr[100].monetary_per_active_month) == (3, 2, 18.0)


def test_sales_obt_one_row_per_order_with_top_category(spark):
    items = spark.createDataFrame([(1, 1, 5, "2.00"), (1, 2, 6, "2.00"), (1, 3, 7, "1.00")],
                                  "order_id long, order_item_id int, product_id long, p string") \
        .withColumn("price", F.col("p").cast("decimal(18,2)")).drop("p")
    products = spark.createDataFrame([(5, "B"), (6, "A"), (7, "C")], "product_id long, product_category_name string")
    vals = LU.order_values(_payments(spark))
    out = {r.order_id: r for r in GX.sales_obt(_orders(spark), vals, items, products, _customers(spark)).collect()}
    assert len(out) == 4
    assert (out[1].n_items, out[1].items_revenue, out[1].top_category) == (3, 5.0, "A")  # tie → smallest name
    assert (out[4].n_items, out[4].top_category, out[4].final_order_value) == (0, None, 0.0)
