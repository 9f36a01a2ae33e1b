"""Data-quality rules, evaluated as Spark jobs, reported as a DataFrame.

Rules: ``NotNull``, ``Unique``, ``Between``, ``ExistsIn``. ``run_rules``
folds every NotNull/Between rule of a table into ONE aggregate (one scan,
partial aggregation on each task); each Unique rule is a grouped count
(partial aggregation absorbs hot keys before the shuffle); each ExistsIn
rule is a ``left_anti`` join count. The result is a lazy DataFrame with one
row per recorded rule; ``gate`` collects that small result (one row per
rule, never the data) and raises ``DataQualityError`` on an error-severity
failure.

Semantics kept from the reference framework:
* not-null: null fraction ≤ threshold (inclusive) passes; an empty table
  records nothing;
* unique: rows == distinct values, NULL counted as one value; an empty
  table records PASS;
* between: rows < min or > max must be 0; NULL is not out of range; empty
  records nothing;
* exists-in: anti-join orphans must be 0; a NULL key is an orphan.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN = "warn"
ERROR = "error"

# Expectation names and statuses of the result log.
EXP_NOT_NULL = "not_be_null"
EXP_UNIQUE = "be_unique"
EXP_BETWEEN = "be_between"
EXP_EXISTS = "referential_integrity"
EXP_TOTAL = "order_is_total"
PASS = "PASS"
FAIL = "FAIL"

_log = logging.getLogger("strata.quality")


class DataQualityError(Exception):
    """Raised by ``gate`` when an error-severity rule fails."""


@dataclass(frozen=True)
class NotNull:
    column: str
    threshold: float = 0.0
    severity: str = ERROR


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]
    severity: str = ERROR

    def __init__(self, columns: str | Sequence[str], severity: str = ERROR):
        object.__setattr__(self, "columns", (columns,) if isinstance(columns, str) else tuple(columns))
        object.__setattr__(self, "severity", severity)


@dataclass(frozen=True)
class Between:
    column: str
    min_value: float
    max_value: float
    severity: str = ERROR


@dataclass(frozen=True)
class CastsCleanly:
    """Every non-NULL value of ``column`` converts to ``dtype`` (schema enforcement)."""
    column: str
    dtype: str
    severity: str = ERROR


@dataclass(frozen=True)
class OrderIsTotal:
    """The columns that choose a key's survivor tell its rows apart.

    Counts the groups of rows that agree on ``columns`` (key and order of a
    dedup) and differ elsewhere: there the survivor would be arbitrary. Equal
    rows are no tie."""
    columns: tuple[str, ...]
    severity: str = WARN

    def __init__(self, columns: Sequence[str], severity: str = WARN):
        object.__setattr__(self, "columns", tuple(columns))
        object.__setattr__(self, "severity", severity)


@dataclass(frozen=True)
class ExistsIn:
    column: str
    parent: DataFrame = field(compare=False)
    parent_column: str
    severity: str = ERROR


def _fmt_num(v: float) -> str:
    return repr(float(v))


def _result(table: str, expectation: str, column: str, failed: Column, observed: Column,
            threshold: str, severity: str) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(expectation).alias("expectation"),
        F.lit(column).alias("column"),
        F.when(failed, F.lit(FAIL)).otherwise(F.lit(PASS)).alias("status"),
        observed.cast("double").alias("observed_value"),
        F.lit(threshold).alias("threshold"),
        F.lit(severity).alias("severity"),
    )


def _single_pass(df: DataFrame, table: str, rules: Sequence) -> DataFrame | None:
    """All column rules (NotNull, Between, CastsCleanly) of one table from a single aggregate."""
    counts = _column_counts(rules)
    if not counts:
        return None
    metrics = df.agg(F.count(F.lit(1)).alias("__total"), *[e.alias(f"__k{i}") for i, (_, e) in enumerate(counts)])
    total = F.col("__total")
    rows = [_column_result(table, r, F.col(f"__k{i}"), total) for i, (r, _) in enumerate(counts)]
    # an empty table records nothing for these expectations
    return metrics.filter(total > 0).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _unique(df: DataFrame, table: str, r: Unique) -> DataFrame:
    """Duplicates = Σ(count − 1) over key groups; NULL keys form one group."""
    groups = df.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("__n"))
    dup = groups.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("__dup"))
    return dup.select(_result(table, EXP_UNIQUE, ",".join(r.columns), F.col("__dup") > 0, F.col("__dup"),
                              "0", r.severity).alias("r")).select("r.*")


def _order_is_total(df: DataFrame, table: str, r: OrderIsTotal) -> DataFrame:
    """Groups whose other columns have more than one hash; min and max combine on the map side."""
    rest = [c for c in df.columns if c not in r.columns]
    value = F.xxhash64(*[F.col(c) for c in rest]) if rest else F.lit(0)
    groups = df.groupBy(*r.columns).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    ties = groups.agg(F.count_if(F.col("__lo") < F.col("__hi")).alias("__ties"))
    return ties.select(_result(table, EXP_TOTAL, ",".join(r.columns), F.col("__ties") > 0, F.col("__ties"), "0",
                               r.severity).alias("r")).select("r.*")


def _exists_in(df: DataFrame, table: str, r: ExistsIn) -> DataFrame:
    """Orphans via left_anti; a NULL child key never matches, so it is an orphan.

    Child rows are first reduced to (key, rows) with a grouped count, so the
    anti join shuffles distinct keys only and a hot key is one row."""
    parent = r.parent.select(F.col(r.parent_column).alias("__pk"))
    keys = df.groupBy(F.col(r.column).alias("__fk")).agg(F.count(F.lit(1)).alias("__n"))
    orphans = keys.join(parent, F.col("__fk") == F.col("__pk"), "left_anti") \
        .agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("__orphans"))
    return orphans.select(_result(table, EXP_EXISTS, r.column, F.col("__orphans") > 0,
                                  F.col("__orphans"), "0", r.severity).alias("r")).select("r.*")


def _column_counts(rules: Sequence) -> list[tuple[object, Column]]:
    """(rule, per-row count expression) for the column rules of a set."""
    out = []
    for r in rules:
        c = F.col(r.column) if hasattr(r, "column") else None
        if isinstance(r, NotNull):
            out.append((r, F.count_if(c.isNull())))
        elif isinstance(r, Between):
            out.append((r, F.count_if((c < F.lit(r.min_value)) | (c > F.lit(r.max_value)))))
        elif isinstance(r, CastsCleanly):
            out.append((r, F.count_if(c.isNotNull() & c.try_cast(r.dtype).isNull())))
    return out


def _column_result(table: str, r, count: Column, total: Column) -> Column:
    if isinstance(r, NotNull):
        frac = count.cast("double") / total.cast("double")
        return _result(table, EXP_NOT_NULL, r.column, frac > F.lit(r.threshold), frac, _fmt_num(r.threshold),
                       r.severity)
    if isinstance(r, Between):
        return _result(table, EXP_BETWEEN, r.column, count > 0, count,
                       f"[{_fmt_num(r.min_value)}, {_fmt_num(r.max_value)}]", r.severity)
    return _result(table, "casts_cleanly", r.column, count > 0, count, r.dtype, r.severity)


def _folded(df: DataFrame, table: str, u: Unique, col_rules: Sequence) -> DataFrame:
    """One uniqueness rule and all column rules from a single scan.

    Level 1 groups by the unique key (partial aggregation first, so a hot key
    is pre-combined per task) and counts rows and rule hits per key; level 2
    sums them. Column rules record nothing on an empty table, the
    uniqueness rule records PASS, as in the separate evaluations."""
    counts = _column_counts(col_rules)
    level1 = df.groupBy(*u.columns).agg(F.count(F.lit(1)).alias("__n"),
                                        *[e.alias(f"__k{i}") for i, (_, e) in enumerate(counts)])
    level2 = level1.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("__total"),
                        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("__dup"),
                        *[F.coalesce(F.sum(f"__k{i}"), F.lit(0)).alias(f"__k{i}") for i in range(len(counts))])
    total = F.col("__total")
    rows = [_result(table, EXP_UNIQUE, ",".join(u.columns), F.col("__dup") > 0, F.col("__dup"), "0", u.severity)]
    rows += [F.when(total > 0, _column_result(table, r, F.col(f"__k{i}"), total)) for i, (r, _) in enumerate(counts)]
    return level2.select(F.explode(F.array(*rows)).alias("r")).filter(F.col("r").isNotNull()).select("r.*")


def run_rules(df: DataFrame, table: str, rules: Sequence) -> DataFrame:
    """Lazy result DataFrame (layout ``contracts.DQ_RESULT``), one row per recorded rule.

    Scans per table: the column rules ride along with the first uniqueness
    rule (one grouped scan); without a uniqueness rule they share one plain
    aggregate; every further uniqueness or foreign-key rule adds one scan."""
    parts = []
    uniques = [r for r in rules if isinstance(r, Unique)]
    col_rules = [r for r in rules if isinstance(r, (NotNull, Between, CastsCleanly))]
    if uniques and col_rules:
        parts.append(_folded(df, table, uniques[0], col_rules))
        uniques = uniques[1:]
    else:
        single = _single_pass(df, table, rules)
        if single is not None:
            parts.append(single)
    for r in rules:
        if isinstance(r, Unique) and r in uniques:
            parts.append(_unique(df, table, r))
        elif isinstance(r, OrderIsTotal):
            parts.append(_order_is_total(df, table, r))
        elif isinstance(r, ExistsIn):
            parts.append(_exists_in(df, table, r))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def union_results(*results: DataFrame) -> DataFrame:
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def gate(results: DataFrame, halt: bool = True) -> bool:
    """Collect the rule results (one row per rule) and halt on error failures.

    Returns True when nothing failed. Warn-severity failures only report.
    """
    rows = results.collect()
    failed = [r for r in rows if r["status"] == FAIL]
    for r in rows:
        level = logging.INFO if r["status"] == PASS else logging.WARNING
        _log.log(level, "[%s] %s.%s %s observed=%s threshold=%s (%s)", r["status"], r["table_name"], r["column"],
                 r["expectation"], r["observed_value"], r["threshold"], r["severity"])
    hard = [r for r in failed if r["severity"] == ERROR]
    if halt and hard:
        names = ", ".join(f"{r['table_name']}.{r['column']}:{r['expectation']}" for r in hard)
        raise DataQualityError(f"critical data quality failure: {names}")
    return not failed


def report(results: DataFrame) -> DataFrame:
    """Human-readable report: fractions as percentages, counts as integers.

    Formatting happens only here; the result log keeps the numbers."""
    pct = F.format_string("%.2f%%", F.col("observed_value") * 100)
    cnt = F.format_string("%d", F.col("observed_value").cast("long"))
    return results.select(
        "table_name", "expectation", "column", "status",
        F.when(F.col("expectation") == EXP_NOT_NULL, pct).otherwise(cnt).alias("observed"),
        "threshold", "severity")


def summary(results: DataFrame) -> DataFrame:
    """Rule counts per table, expectation and status (the DQ dashboard view)."""
    return results.groupBy("table_name", "expectation", "status").agg(F.count(F.lit(1)).alias("n_rules"))


def null_profile(df: DataFrame, table: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: null count and share, from one aggregate pass, stacked to rows."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__total")] + [F.count_if(F.col(c).isNull()).alias(f"__n{i}")
                                                    for i, c in enumerate(cols)]
    m = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"__n{i}").alias("null_count"))
            for i, c in enumerate(cols)]
    out = m.select("__total", F.explode(F.array(*rows)).alias("r"))
    return out.select(
        F.lit(table).alias("table_name"), "r.column", "r.null_count",
        F.when(F.col("__total") > 0, F.col("r.null_count").cast("double") / F.col("__total").cast("double"))
        .alias("null_pct"))


def observe_rules(df: DataFrame, rules: Sequence, name: str = "dq") -> tuple[DataFrame, Observation]:
    """Attach NotNull/Between metrics to a DataFrame that is about to be written.

    The metrics are computed by the write itself (no extra pass). After the
    action, ``observation.get`` holds ``total`` and one count per rule.
    """
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("total")]
    for r in rules:
        if isinstance(r, NotNull):
            metrics.append(F.count_if(F.col(r.column).isNull()).alias(f"nulls:{r.column}"))
        elif isinstance(r, Between):
            c = F.col(r.column)
            metrics.append(F.count_if((c < F.lit(r.min_value)) | (c > F.lit(r.max_value)))
                           .alias(f"out_of_range:{r.column}"))
    return df.observe(obs, *metrics), obs


def schema_results(df: DataFrame, contract, table: str, spark) -> DataFrame:
    """Schema check (Q10): one result row per difference from the contract."""
    from ..sources.contracts import DQ_RESULT, schema_diff
    diffs = schema_diff(df, contract, table)
    rows = [(table, f"schema_{problem}", col, "FAIL", None, str(expected), ERROR)
            for (_, col, expected, _actual, problem) in diffs]
    if not rows:
        rows = [(table, "schema_match", "*", "PASS", 0.0, "0", ERROR)]
    return spark.createDataFrame(rows, schema=DQ_RESULT)


class RuleSet:
    """Chainable rule set for one table, evaluated together by ``run_rules``.

        ok = (RuleSet(orders, "orders")
              .not_null("order_id").unique("order_id").between("quantity", 0, 100)
              .validate(halt=True))

    Nothing runs until ``results`` or ``validate``; all rules of the set share
    the scans ``run_rules`` plans (one grouped scan for column rules plus the
    first uniqueness rule)."""

    def __init__(self, df: DataFrame, table: str):
        self.df, self.table, self.rules = df, table, []

    def not_null(self, column: str, threshold: float = 0.0, severity: str = ERROR) -> "RuleSet":
        self.rules.append(NotNull(column, threshold, severity))
        return self

    def unique(self, columns: str | Sequence[str], severity: str = ERROR) -> "RuleSet":
        self.rules.append(Unique(columns, severity))
        return self

    def between(self, column: str, min_value: float, max_value: float, severity: str = ERROR) -> "RuleSet":
        self.rules.append(Between(column, min_value, max_value, severity))
        return self

    def exists_in(self, column: str, parent: DataFrame, parent_column: str, severity: str = ERROR) -> "RuleSet":
        self.rules.append(ExistsIn(column, parent, parent_column, severity))
        return self

    def casts_cleanly(self, column: str, dtype: str, severity: str = ERROR) -> "RuleSet":
        self.rules.append(CastsCleanly(column, dtype, severity))
        return self

    def results(self) -> DataFrame:
        return run_rules(self.df, self.table, self.rules)

    def validate(self, halt: bool = False) -> bool:
        return gate(self.results(), halt=halt)
