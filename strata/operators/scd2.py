"""Slowly changing dimension, type 2, on plain DataFrames.

Versions carry ``effective_date`` (inclusive), ``end_date`` (exclusive,
9999-12-31 while open) and ``is_current``. ``scd2_merge`` returns the whole
new dimension; publishing it is a write to a new folder plus a swap
(``strata.plans.maintenance.publish_swap``), so readers never see half a merge.

Modes:
* ``always`` — the reference's behaviour: every incoming key with a current
  version closes it and inserts a new version even if nothing changed, so
  re-running grows the table and same-day runs leave zero-length versions.
* ``on_change`` (default) — only a key whose tracked columns differ
  (null-safe) gets a new version; re-running the same delivery is a no-op;
  a second change on the same day replaces that day's version.

Incoming NULL keys never match a version; they are left out of the merge
and returned by ``scd2_rejects``. Duplicate incoming keys are reduced to one
row deterministically first. ``strata.plans.scd2_store`` keeps a dimension by key bucket, so a
merge rewrites only buckets that change. The merge is one full outer join on the key. A
delivery dated before the current version of one of its keys is an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import dedup_latest

# The open-ended version's end date and the version columns.
OPEN_END = "9999-12-31"
META = ["effective_date", "end_date", "is_current"]


def _d(v: date | str | Column) -> Column:
    return v if isinstance(v, Column) else F.lit(str(v)).cast("date")


def scd2_initial(df: DataFrame, as_of: date | str | Column) -> DataFrame:
    """Stamp a first load: effective today, open end, current."""
    return df.withColumns({"effective_date": _d(as_of), "end_date": _d(OPEN_END),
                           "is_current": F.lit(True)})


def scd2_current(dim: DataFrame) -> DataFrame:
    """Current versions; of a dimension stored by bucket only their partitions are scanned."""
    current = F.col("is_current")
    return dim.filter((F.col("is_history") == 0) & current if "is_history" in dim.columns else current)


def scd2_as_of(dim: DataFrame, as_of: date | str | Column) -> DataFrame:
    """Versions valid on a date: effective_date <= d < end_date."""
    d = _d(as_of)
    return dim.filter((F.col("effective_date") <= d) & (d < F.col("end_date")))


def scd2_rejects(updates: DataFrame, key: str) -> DataFrame:
    return updates.filter(F.col(key).isNull())


def scd2_merge(dim: DataFrame, updates: DataFrame, key: str, as_of: date | str | Column,
               tracked: Sequence[str] | None = None, mode: str = "on_change") -> DataFrame:
    if mode not in ("always", "on_change"):
        raise ValueError(f"unknown SCD2 mode {mode!r}")
    attrs = [c for c in dim.columns if c not in META and c != key]
    tracked = list(tracked or attrs)
    d = _d(as_of)

    upd = updates.filter(F.col(key).isNotNull()).select(key, *attrs)
    upd = dedup_latest(upd, [key], list(tracked))

    # a NULL flag counts as "not current", so no row can fall out of both branches
    current_flag = F.coalesce(F.col("is_current"), F.lit(False))
    history = dim.filter(~current_flag)
    cur = dim.filter(current_flag)

    # one shuffle per side and one join on the key (a key has one current
    # version, or a few to repair); each key leaves with its next versions
    old = cur.groupBy(F.col(key).alias("o__key")).agg(F.collect_list(F.struct(*dim.columns)).alias("old"))
    new = scd2_initial(upd, d).select(F.col(key).alias("n__key"), F.struct(*dim.columns).alias("new"))
    j = old.join(new, F.col("o__key") == F.col("n__key"), "full_outer")
    # history only grows at its end: an older delivery must not close a newer version
    newer = F.exists("old", lambda o: o["effective_date"] > d)
    j = j.filter(F.assert_true(
        F.coalesce(~(newer & F.col("new").isNotNull()), F.lit(True)),
        "scd2_merge: as_of lies before the current version of a delivered key").isNull())

    def same(o: Column) -> Column:
        if mode == "always":
            return F.lit(False)
        return reduce(and_, [o[c].eqNullSafe(F.col("new")[c]) for c in tracked], F.lit(True))

    def closed(o: Column) -> Column:
        return F.when(same(o), o).otherwise(o.withField("end_date", d).withField("is_current", F.lit(False)))

    # on_change: a version that began on the same day is replaced, not closed
    stay = F.col("old") if mode == "always" else F.filter("old", lambda o: same(o) | (o["effective_date"] != d))
    added = F.when(F.exists("old", same), F.array().cast(j.schema["old"].dataType)).otherwise(F.array("new"))
    versions = (F.when(F.col("old").isNull(), F.array("new")).when(F.col("new").isNull(), F.col("old"))
                .otherwise(F.concat(F.transform(stay, closed), added)))
    return history.unionByName(j.select(F.inline(versions)).select(*dim.columns))


def point_in_time_join(facts: DataFrame, dim: DataFrame, key: str, fact_date: Column | str,
                       dim_cols: Sequence[str]) -> DataFrame:
    """Facts ⋈ the dimension version valid on the fact's date.

    Equi-join on the key plus a range predicate on [effective_date, end_date);
    the planner uses the key for the shuffle or broadcast and evaluates the
    range as a join condition, so each fact meets only its key's versions.
    """
    fd = F.col(fact_date) if isinstance(fact_date, str) else fact_date
    f = facts.withColumn("__fact_date", fd.cast("date"))
    v = dim.select(F.col(key).alias("__dk"), *dim_cols, "effective_date", "end_date")
    cond = (F.col(key) == F.col("__dk")) & (F.col("effective_date") <= F.col("__fact_date")) \
        & (F.col("__fact_date") < F.col("end_date"))
    return f.join(v, cond, "left").drop("__dk", "__fact_date")
