import pytest
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.operators.dedup import dedup_latest, duplicate_keys


def test_dedup_tie_broken_by_last_column(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01", "b"), (1, "2024-01-01", "a"), (2, "2024-01-02", "z"), (None, "x", "q"),
         (None, "y", "r")], "k int, ts string, tb string")
    out = dedup_latest(df, ["k"], [F.col("ts").desc(), "tb"]).orderBy("k").collect()
    assert [(r.k, r.tb) for r in out] == [(None, "r"), (1, "a"), (2, "z")]


def test_dedup_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id"))
    plan = dedup_latest(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    got = {(r.k, r.n_rows) for r in duplicate_keys(df, ["k"]).collect()}
    assert got == {(1, 2), (None, 2)}


def _rows(df):
    return {(r.expectation, r.column): r for r in df.collect()}


def test_not_null_threshold_inclusive_and_empty(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (4,)], "a int")
    r = _rows(Q.run_rules(df, "t", [Q.NotNull("a", 0.25)]))[("not_be_null", "a")]
    assert r.status == "PASS" and r.observed_value == 0.25
    r = _rows(Q.run_rules(df, "t", [Q.NotNull("a", 0.2)]))[("not_be_null", "a")]
    assert r.status == "FAIL"
    empty = df.limit(0)
    assert Q.run_rules(empty, "t", [Q.NotNull("a"), Q.Between("a", 0, 1)]).count() == 0
    assert _rows(Q.run_rules(empty, "t", [Q.Unique("a")]))[("be_unique", "a")].status == "PASS"


def test_unique_counts_null_once(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "a int")
    r = _rows(Q.run_rules(df, "t", [Q.Unique("a")]))[("be_unique", "a")]
    assert r.status == "FAIL" and r.observed_value == 1.0


def test_between_bounds_and_null(spark):
    df = spark.createDataFrame([(1,), (5,), (None,), (6,)], "a int")
    r = _rows(Q.run_rules(df, "t", [Q.Between("a", 1, 5)]))[("be_between", "a")]
    assert r.status == "FAIL" and r.observed_value == 1.0


def test_exists_in_null_is_orphan(spark):
    child = spark.createDataFrame([(1,), (None,), (2,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    r = _rows(Q.run_rules(child, "t", [Q.ExistsIn("fk", parent, "pk")]))[("referential_integrity", "fk")]
    assert r.status == "FAIL" and r.observed_value == 1.0


def test_gate_halts_only_on_error(spark):
    df = spark.createDataFrame([(None,)], "a int")
    warn = Q.run_rules(df, "t", [Q.NotNull("a", severity=Q.WARN)])
    assert Q.gate(warn, halt=True) is False
    err = Q.run_rules(df, "t", [Q.NotNull("a")])
    with pytest.raises(Q.DataQualityError):
        Q.gate(err, halt=True)


def test_single_pass_for_column_rules(spark):
    df = spark.range(100).select(F.col("id").alias("a"), (F.col("id") % 3).alias("b"))
    res = Q.run_rules(df, "t", [Q.NotNull("a"), Q.NotNull("b"), Q.Between("b", 0, 1)])
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1  # one scan feeds all three rules


def test_observe_rules_on_write(spark, tmp_dir):
    df = spark.createDataFrame([(1,), (None,), (9,)], "a int")
    observed, obs = Q.observe_rules(df, [Q.NotNull("a"), Q.Between("a", 0, 5)])
    observed.write.mode("overwrite").parquet(f"{tmp_dir}/o")
    m = obs.get
    assert m["total"] == 3 and m["nulls:a"] == 1 and m["out_of_range:a"] == 1


def test_casts_cleanly_rule(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("99999999999",)], "a string")
    r = _rows(Q.run_rules(df, "t", [Q.CastsCleanly("a", "int")]))[("casts_cleanly", "a")]
    assert r.status == "FAIL" and r.observed_value == 2.0


def test_public_api_imports():
    import strata
    assert all(hasattr(strata, n) for n in strata.__all__)


def test_folded_rules_match_separate_evaluation(spark):
    df = spark.createDataFrame([(1, None, 5), (1, 2, 9), (2, 3, None), (None, 4, 1)], "k int, a int, b int")
    rules = [Q.NotNull("a", 0.1), Q.Between("b", 1, 5), Q.Unique("k"), Q.CastsCleanly("a", "int")]
    folded = {(r.expectation, r.column): (r.status, r.observed_value) for r in Q.run_rules(df, "t", rules).collect()}
    separate = {}
    for rule in rules:
        for r in Q.run_rules(df, "t", [rule]).collect():
            separate[(r.expectation, r.column)] = (r.status, r.observed_value)
    assert folded == separate and len(folded) == 4
    plan = Q.run_rules(df, "t", rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1  # one scan for all four rules
    empty = Q.run_rules(df.limit(0), "t", rules).collect()
    assert [(r.expectation, r.status) for r in empty] == [("be_unique", "PASS")]


def test_chainable_rule_set(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (2, 7)], "k int, q int")
    rs = Q.RuleSet(df, "t").not_null("q", 0.5).unique("k").between("q", 0, 6)
    got = {(r.expectation, r.status) for r in rs.results().collect()}
    assert got == {("not_be_null", "PASS"), ("be_unique", "FAIL"), ("be_between", "FAIL")}
    assert rs.validate(halt=False) is False
    with pytest.raises(Q.DataQualityError):
        rs.validate(halt=True)


def test_order_is_total_counts_ties(spark):
    rows = [(1, "a", "x"), (1, "a", "y"), (1, "b", "x"),  # a tie on (k, t)
            (2, "a", "x"), (2, "a", "x"),                 # equal rows: no tie
            (None, "a", "x"), (None, "a", None)]          # a tie of a NULL key
    df = spark.createDataFrame(rows, "k int, t string, v string")
    r = Q.run_rules(df, "t", [Q.OrderIsTotal(["k", "t"])]).collect()
    assert [(x.status, x.observed_value, x.severity) for x in r] == [("FAIL", 2.0, "warn")]
    assert Q.run_rules(df, "t", [Q.OrderIsTotal(["k", "t", "v"])]).first().status == "PASS"
    assert Q.run_rules(df.limit(0), "t", [Q.OrderIsTotal(["k", "t"])]).first().status == "PASS"
