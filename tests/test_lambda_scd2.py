import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import lambda_union as LU
from strata.operators import scd2 as K

BATCH_SCHEMA = "order_id long, customer_id long, order_status string, order_purchase_timestamp timestamp_ntz, " \
               "year int, month int"
STREAM_SCHEMA = "order_id long, customer_id long, order_status string, event_timestamp timestamp, " \
                "order_value double, customer_state string"


def _batch(spark, rows):
    return spark.createDataFrame(rows, BATCH_SCHEMA)


def _stream(spark, rows):
    return spark.createDataFrame(rows, STREAM_SCHEMA)


T1 = dt.datetime(2024, 1, 5, 10, 0)
T2 = dt.datetime(2024, 1, 6, 11, 0)


def test_unify_batch_wins_and_stream_fills(spark):
    b = _batch(spark, [(1, 10, "F", T1, 2024, 1), (2, 11, "O", T1, 2024, 1)])
    s = _stream(spark, [(2, 11, "purchase", T2, 5.5, "X"), (3, 12, "view", T2, 7.25, "Y")])
    out = {r.order_id: r for r in LU.unify_orders(b, s).collect()}
    assert out[2].origin == "batch" and out[2].order_status == "O"
    assert out[3].origin == "stream" and out[3].year == 2024 and out[3].month == 1
    assert float(out[3].order_value) == 7.25
    assert "customer_state" not in LU.unify_orders(b, s).columns


def test_unify_without_stream_and_empty_stream(spark):
    b = _batch(spark, [(1, 10, "F", T1, 2024, 1)])
    assert LU.unify_orders(b).count() == 1
    assert LU.unify_orders(b, _stream(spark, [])).count() == 1


def test_unify_null_key_halts(spark):
    b = _batch(spark, [(None, 10, "F", T1, 2024, 1)])
    with pytest.raises(Exception, match="NULL order_id"):
        LU.unify_orders(b).collect()


def test_unify_independent_of_partitioning(spark):
    rows = [(i % 50, i, "F", T1 + dt.timedelta(hours=i), 2024, 1) for i in range(400)]
    b = _batch(spark, rows)
    a = sorted(LU.unify_orders(b.repartition(1)).collect())
    c = sorted(LU.unify_orders(b.repartition(13, "customer_id")).collect())
    assert a == c


def test_final_value_fallbacks(spark):
    u = spark.createDataFrame([(1, None), (2, 3.5), (3, None)], "order_id long, order_value double")
    v = spark.createDataFrame([(1, 10.0)], "order_id long, order_value double") \
        .withColumn("order_value", F.col("order_value").cast("decimal(18,2)"))
    got = {r.order_id: float(r.final_order_value) for r in LU.valued_orders(u, v).collect()}
    assert got == {1: 10.0, 2: 3.5, 3: 0.0}


DIM_SCHEMA = "customer_id long, state string"
D1, D2 = "2024-01-01", "2024-01-16"


def _dim(spark, rows):
    return K.scd2_initial(spark.createDataFrame(rows, DIM_SCHEMA), D1)


def _current(df):
    return {r.customer_id: r.state for r in df.filter("is_current").collect()}


def test_scd2_on_change_cases(spark):
    dim = _dim(spark, [(1, "A"), (2, "B"), (3, "C"), (4, None)])
    upd = spark.createDataFrame([(1, "A"), (2, "BB"), (5, "E"), (None, "Z"), (4, "D")], DIM_SCHEMA)
    out = K.scd2_merge(dim, upd, "customer_id", D2)
    assert _current(out) == {1: "A", 2: "BB", 3: "C", 4: "D", 5: "E"}
    closed = {r.customer_id: (str(r.end_date), r.is_current) for r in out.filter("not is_current").collect()}
    assert closed == {2: (D2, False), 4: (D2, False)}
    assert out.filter(F.col("customer_id").isNull()).count() == 0
    # re-running the same delivery is a no-op
    again = K.scd2_merge(out, upd, "customer_id", D2)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, out.collect()))


def test_scd2_value_to_null_is_a_change(spark):
    dim = _dim(spark, [(1, "A")])
    out = K.scd2_merge(dim, spark.createDataFrame([(1, None)], DIM_SCHEMA), "customer_id", D2)
    assert _current(out) == {1: None} and out.count() == 2


def test_scd2_same_day_second_change_replaces(spark):
    dim = _dim(spark, [(1, "A")])
    first = K.scd2_merge(dim, spark.createDataFrame([(1, "B")], DIM_SCHEMA), "customer_id", D2)
    second = K.scd2_merge(first, spark.createDataFrame([(1, "C")], DIM_SCHEMA), "customer_id", D2)
    rows = sorted((r.state, str(r.effective_date), str(r.end_date)) for r in second.collect())
    assert rows == [("A", D1, D2), ("C", D2, "9999-12-31")]


def test_scd2_always_mode_reproduces_growth(spark):
    dim = _dim(spark, [(1, "A"), (2, "B"), (3, "C"), (4, "D")])
    upd = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, "D")], DIM_SCHEMA)
    one = K.scd2_merge(dim, upd, "customer_id", D2, mode="always")
    two = K.scd2_merge(one, upd, "customer_id", D2, mode="always")
    assert (dim.count(), one.count(), two.count()) == (4, 8, 12)
    assert two.filter("is_current").groupBy("customer_id").count().filter("count > 1").count() == 0


def test_scd2_invariants_and_point_in_time(spark):
    dim = _dim(spark, [(1, "A"), (2, "B")])
    out = K.scd2_merge(dim, spark.createDataFrame([(1, "A2")], DIM_SCHEMA), "customer_id", D2)
    # one current row per key, versions do not overlap
    assert out.filter("is_current").groupBy("customer_id").count().filter("count > 1").count() == 0
    facts = spark.createDataFrame([(10, 1, dt.datetime(2024, 1, 10)), (11, 1, dt.datetime(2024, 1, 20)),
                                   (12, 9, dt.datetime(2024, 1, 20))], "order_id long, customer_id long, ts timestamp")
    got = {r.order_id: r.state for r in K.point_in_time_join(facts, out, "customer_id", "ts", ["state"]).collect()}
    assert got == {10: "A", 11: "A2", 12: None}
    assert {r.customer_id for r in K.scd2_as_of(out, "2024-01-10").collect()} == {1, 2}


def test_scd2_null_current_flag_is_kept_as_history(spark):
    dim = _dim(spark, [(1, "A")]).unionByName(
        spark.createDataFrame([(9, "Z")], DIM_SCHEMA).withColumns(
            {"effective_date": F.lit(D1).cast("date"), "end_date": F.lit(D2).cast("date"),
             "is_current": F.lit(None).cast("boolean")}))
    out = K.scd2_merge(dim, spark.createDataFrame([(1, "B")], DIM_SCHEMA), "customer_id", D2)
    assert out.count() == 3 and out.filter("customer_id = 9").count() == 1


def test_scd2_two_current_rows_for_one_key_are_repaired(spark):
    dim = _dim(spark, [(1, "A"), (1, "B"), (2, "X")])  # corrupt: key 1 has two current versions
    out = K.scd2_merge(dim, spark.createDataFrame([(1, "C")], DIM_SCHEMA), "customer_id", D2)
    assert _current(out) == {1: "C", 2: "X"}
    assert out.filter("customer_id = 1 AND NOT is_current").count() == 2
    # a delivery equal to one of the two current rows keeps that one and closes the other
    same = K.scd2_merge(dim, spark.createDataFrame([(1, "A")], DIM_SCHEMA), "customer_id", D2)
    assert _current(same) == {1: "A", 2: "X"}
    assert same.filter("customer_id = 1").count() == 2
