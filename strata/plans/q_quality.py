"""Registered data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup as DD
from ..operators import quality as Q
from . import oracle as O
from .layers import Layers
from .registry import query

# Rule sets. Table name → (Spark view of Layers, oracle CTE).
_TABLES = {
    "raw_reviews": (lambda L: L.raw_reviews_df, "raw_reviews"),
    "silver_orders": (lambda L: L.orders, "s_orders"),
    "raw_events": (lambda L: L.raw_events, "raw_events"),
    "raw_order_items": (lambda L: L.raw_items, "raw_items"),
    "silver_order_items": (lambda L: L.items, "s_items"),
    "silver_customers": (lambda L: L.customers, "s_customers"),
    "silver_payments": (lambda L: L.payments, "s_payments"),
    "silver_reviews": (lambda L: L.reviews, "s_reviews"),
    "lambda_orders": (lambda L: L.unified_orders, "unified"),
}

NOT_NULL = [("raw_reviews", "review_comment_message", 0.2, Q.WARN),
            ("raw_reviews", "review_comment_title", 0.5, Q.WARN),
            ("silver_orders", "order_id", 0.0, Q.ERROR),
            ("silver_orders", "customer_id", 0.01, Q.ERROR),
            ("raw_events", "order_value", 0.0, Q.ERROR)]
UNIQUE = [("raw_order_items", ("order_id", "order_item_id"), Q.WARN),
          ("silver_order_items", ("order_id", "order_item_id"), Q.ERROR),
          ("silver_orders", ("order_id",), Q.ERROR),
          ("silver_customers", ("customer_unique_id",), Q.WARN)]
BETWEEN = [("silver_reviews", "review_score", 1.0, 5.0, Q.ERROR),
           ("silver_order_items", "quantity", 1.0, 40.0, Q.WARN),
           ("silver_order_items", "discount", 0.0, 0.08, Q.WARN),
           ("silver_payments", "payment_installments", 1.0, 50.0, Q.ERROR)]
# (child table, column, parent table, parent column)
EXISTS = [("silver_order_items", "product_id", "silver_products", "product_id", Q.ERROR),
          ("silver_orders", "customer_id", "silver_customers", "customer_id", Q.ERROR),
          ("lambda_orders", "order_id", "silver_orders", "order_id", Q.WARN),
          ("silver_reviews", "order_id", "silver_orders", "order_id", Q.ERROR)]
_PARENTS = {"silver_products": (lambda L: L.products, "s_products"),
            "silver_customers": (lambda L: L.customers, "s_customers"),
            "silver_orders": (lambda L: L.orders, "s_orders")}


def _rules_by_table(L, kind):
    out: dict[str, list] = {}
    if kind == "not_null":
        for t, c, thr, sev in NOT_NULL:
            out.setdefault(t, []).append(Q.NotNull(c, thr, sev))
    elif kind == "unique":
        for t, cols, sev in UNIQUE:
            out.setdefault(t, []).append(Q.Unique(cols, sev))
    elif kind == "between":
        for t, c, lo, hi, sev in BETWEEN:
            out.setdefault(t, []).append(Q.Between(c, lo, hi, sev))
    elif kind == "exists":
        for t, c, pt, pc, sev in EXISTS:
            out.setdefault(t, []).append(Q.ExistsIn(c, _PARENTS[pt][0](L), pc, sev))
    return out


def _results(spark, sf, kinds):
    """All rules of the requested kinds, evaluated per table in one ``run_rules``
    call, so a table's column rules fold into its uniqueness scan."""
    L = Layers(spark, sf)
    per_table: dict[str, list] = {}
    for kind in kinds:
        for table, rules in _rules_by_table(L, kind).items():
            per_table.setdefault(table, []).extend(rules)
    return Q.union_results(*[Q.run_rules(_TABLES[t][0](L), t, rules) for t, rules in per_table.items()])


def _sql_row(table, exp, col, failed, observed, threshold, sev, src, where=""):
    return (f"SELECT '{table}' AS table_name, '{exp}' AS expectation, '{col}' AS \"column\", "
            f"CASE WHEN {failed} THEN 'FAIL' ELSE 'PASS' END AS status, CAST({observed} AS DOUBLE) AS observed_value, "
            f"'{threshold}' AS threshold, '{sev}' AS severity FROM {src} {where}")


def _sql_not_null():
    parts = []
    for t, c, thr, sev in NOT_NULL:
        src = f"(SELECT count(*) AS tot, count(*) FILTER (WHERE {c} IS NULL) AS n FROM {_TABLES[t][1]})"
        frac = "CAST(n AS DOUBLE) / CAST(tot AS DOUBLE)"
        parts.append(_sql_row(t, "not_be_null", c, f"{frac} > {thr}", frac, repr(float(thr)), sev, src,
                              "WHERE tot > 0"))
    return parts


def _sql_unique():
    parts = []
    for t, cols, sev in UNIQUE:
        k = ", ".join(cols)
        src = f"(SELECT COALESCE(SUM(n - 1), 0) AS dup FROM (SELECT count(*) AS n FROM {_TABLES[t][1]} GROUP BY {k}))"
        parts.append(_sql_row(t, "be_unique", ",".join(cols), "dup > 0", "dup", "0", sev, src))
    return parts


def _sql_between():
    parts = []
    for t, c, lo, hi, sev in BETWEEN:
        src = (f"(SELECT count(*) AS tot, count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS oob "
               f"FROM {_TABLES[t][1]})")
        parts.append(_sql_row(t, "be_between", c, "oob > 0", "oob", f"[{lo!r}, {hi!r}]", sev, src,
                              "WHERE tot > 0"))
    return parts


def _sql_exists():
    parts = []
    for t, c, pt, pc, sev in EXISTS:
        src = (f"(SELECT count(*) AS orphans FROM {_TABLES[t][1]} ch WHERE NOT EXISTS "
               f"(SELECT 1 FROM {_PARENTS[pt][1]} pa WHERE pa.{pc} = ch.{c}))")
        parts.append(_sql_row(t, "referential_integrity", c, "orphans > 0", "orphans", "0", sev, src))
    return parts


_ALL_VIEWS = ("raw_reviews", "s_orders", "raw_events", "raw_items", "s_items", "s_customers", "s_payments",
              "s_reviews", "unified", "s_products")


def _union_sql(parts):
    return O.sql("\nUNION ALL\n".join(parts), *_ALL_VIEWS)


@query("dq_not_null", _union_sql(_sql_not_null()))
def q_dq_not_null(spark, sf):
    return _results(spark, sf, ["not_null"])


@query("dq_unique", _union_sql(_sql_unique()))
def q_dq_unique(spark, sf):
    return _results(spark, sf, ["unique"])


@query("dq_between", _union_sql(_sql_between()))
def q_dq_between(spark, sf):
    return _results(spark, sf, ["between"])


@query("dq_referential", _union_sql(_sql_exists()))
def q_dq_referential(spark, sf):
    return _results(spark, sf, ["exists"])


@query("dq_summary", O.sql(
    "SELECT table_name, expectation, status, count(*) AS n_rules FROM ("
    + "\nUNION ALL\n".join(_sql_not_null() + _sql_unique() + _sql_between() + _sql_exists())
    + ") r GROUP BY table_name, expectation, status", *_ALL_VIEWS))
def q_dq_summary(spark, sf):
    return Q.summary(_results(spark, sf, ["not_null", "unique", "between", "exists"]))


_PROFILE_COLS = ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message"]


@query("null_profile", O.sql("\nUNION ALL\n".join(
    f"SELECT 'raw_reviews' AS table_name, '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE) "
    f"END AS null_pct FROM raw_reviews" for c in _PROFILE_COLS), "raw_reviews"))
def q_null_profile(spark, sf):
    return Q.null_profile(Layers(spark, sf).raw_reviews_df, "raw_reviews", _PROFILE_COLS)


@query("duplicate_keys", O.sql("""
    SELECT order_id, order_item_id, count(*) AS n_rows FROM raw_items
    GROUP BY order_id, order_item_id HAVING count(*) > 1""", "raw_items"))
def q_duplicate_keys(spark, sf):
    return DD.duplicate_keys(Layers(spark, sf).raw_items, ["order_id", "order_item_id"])


@query("layer_reconciliation", O.sql("""
    SELECT s.silver_keys, g.gold_rows, s.silver_keys = g.gold_rows AS counts_match
    FROM (SELECT count(DISTINCT order_id) AS silver_keys FROM
            (SELECT order_id FROM s_orders UNION ALL SELECT order_id FROM stream_orders)) s,
         (SELECT count(*) AS gold_rows FROM unified) g""", "s_orders", "stream_orders", "unified"))
def q_layer_reconciliation(spark, sf):
    L = Layers(spark, sf)
    keys = L.orders.select("order_id").unionByName(L.stream_orders.select("order_id"))
    gold_rows = L.unified_orders.agg(F.count(F.lit(1))).scalar()
    return keys.agg(F.count_distinct("order_id").alias("silver_keys")) \
        .select("silver_keys", gold_rows.alias("gold_rows")) \
        .withColumn("counts_match", F.col("silver_keys") == F.col("gold_rows"))


@query("lambda_duplicate_report", O.sql("""
    SELECT 'lambda_union' AS table_name, 'be_unique' AS expectation, 'order_id' AS "column",
           CASE WHEN dup > 0 THEN 'FAIL' ELSE 'PASS' END AS status, CAST(dup AS DOUBLE) AS observed_value,
           '0' AS threshold, 'warn' AS severity
    FROM (SELECT COALESCE(SUM(n - 1), 0) AS dup FROM
           (SELECT count(*) AS n FROM (SELECT order_id FROM s_orders UNION ALL SELECT order_id FROM stream_orders) u
            GROUP BY order_id))""", "s_orders", "stream_orders"))
def q_lambda_duplicate_report(spark, sf):
    """Q7: overlap of batch and stream keys, reported before survivor selection."""
    from ..operators import lambda_union as LU
    L = Layers(spark, sf)
    cand = LU.union_candidates(L.orders, L.stream_orders)
    return Q.run_rules(cand, "lambda_union", [Q.Unique("order_id", Q.WARN)])
