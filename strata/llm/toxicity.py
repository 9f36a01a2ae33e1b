"""Toxicity: cumulative-link ordinal regression over sparse text features.

Severity grades 0 < 1 < ... < K share one weight vector; ordered thresholds
t1 < ... < tK cut the same score: P(grade >= k) = sigmoid(w.x - tk). The
expected severity is the sum of these probabilities over k.

Features are the lower-cased words of a text and their first ``PREFIXES`` bytes,
present or not. The model is fitted on a bounded sample of labelled rows: at
most ``per_class`` toxic and ``per_class`` other documents (default 4096),
the first by a hash of the id. Feature counts, the choice of the ``n_features``
features that depart most from the toxic share, the grades and the fit use all
of that sample. Its rows are weighted by the labels of their class (toxic or
other, counted over all labels) per sampled label of that class, so shares,
thresholds and probabilities are those of all labels, whatever their number.
Scoring reads every document and every word.

Labels of two values (0/1) are refined to grades 0 to 3: toxic documents are
cut at the terciles of how many different strongly toxic features they hold.

Defined results: null and empty texts have no features and get the score of
the intercepts. Without both classes among the labels there is no model:
severity 0, grade 0, not toxic. Labels with a null grade or id, or without a
document, are left out; an id labelled more than once counts with its highest
grade. Other columns pass through; input columns named like a result are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, quoted, written
from .textkit import mix, pieces, span_hashes, text_bytes, word_spans

QUERY = "op10_toxicity"
ORACLE = None  # a fitted model; tests/llm/test_toxicity.py measures held-out accuracy

PER_CLASS = 4096
N_FEATURES = 1024
PREFIXES = (4, 6)
LEAST_DOCS = 5
CUT = 0.4  # P(grade >= 1) from which a document counts as toxic

_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = True
_LETTERS[128:] = True


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature of every word and word prefix."""
    data, ends = text_bytes(texts)
    starts, stops = word_spans(data, ends, _LETTERS)
    rows = np.searchsorted(ends, starts, side="right") - 1
    found = [span_hashes(data, starts, stops)]
    for n in PREFIXES:
        found.append(mix(span_hashes(data, starts, np.minimum(stops, starts + n)) ^ np.uint64(n)))
    return np.tile(rows, len(found)), np.concatenate(found)


@dataclass(frozen=True)
class OrdinalModel:
    """Sorted feature ids, their shared weights, and the ordered thresholds."""

    ids: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, texts: pa.Array) -> np.ndarray:
        """P(grade >= k) for k = 1 ... K, a row per text."""
        rows, found = features(texts)
        seen = np.zeros(1 << 16, bool)
        seen[(self.ids >> np.uint64(48)).astype(np.int64)] = True
        maybe = seen[(found >> np.uint64(48)).astype(np.int64)]
        rows, found = rows[maybe], found[maybe]
        at = np.minimum(np.searchsorted(self.ids, found), len(self.ids) - 1)
        hit = self.ids[at] == found
        pairs = np.unique(rows[hit] * len(self.ids) + at[hit])
        score = np.bincount(pairs // len(self.ids), self.weights[pairs % len(self.ids)], len(texts))
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, n_cols: int, grades: np.ndarray, steps: int = 400,
                rate: float = 1.0, decay: float = 1e-5, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the cumulative-link model, by gradient steps with per-coordinate rates.

    ``rows, cols`` are the places of ones in the feature matrix, ``weight``
    the labels that each document stands for (one each if not given).
    Thresholds are kept in order by writing their gaps as exponentials.
    """
    n, top = len(grades), int(grades.max())
    part = np.full(n, 1 / n) if weight is None else weight / weight.sum()
    share = np.array([part[grades >= k].sum() for k in range(1, top + 1)])
    share = np.clip(share, 1e-9, 1 - 1e-9)
    cuts = np.sort(np.log(1 / share - 1))
    free = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 0.1))])
    w = np.zeros(n_cols)
    past_w, past_t = np.full(n_cols, 1e-8), np.full(top, 1e-8)
    index = np.arange(n)
    for _ in range(steps):
        gaps = np.exp(free[1:])
        cuts = free[0] + np.concatenate([[0], np.cumsum(gaps)])
        score = np.bincount(rows, w[cols], n)
        above = np.hstack([np.ones((n, 1)), _sigmoid(score[:, None] - cuts[None, :]), np.zeros((n, 1))])
        slope = above * (1 - above)
        low, high = above[index, grades], above[index, grades + 1]
        p = np.maximum(low - high, 1e-12)
        d_low, d_high = part * slope[index, grades] / p, part * slope[index, grades + 1] / p
        grad_w = -np.bincount(cols, (d_low - d_high)[rows], n_cols) + decay * w
        d_cut = np.zeros(top + 2)
        np.add.at(d_cut, grades, d_low)
        np.add.at(d_cut, grades + 1, -d_high)
        d_cut = d_cut[1:-1]
        tail = np.cumsum(d_cut[::-1])[::-1]
        grad_t = np.concatenate([tail[:1], tail[1:] * gaps])
        past_w += grad_w**2
        past_t += grad_t**2
        w -= rate * grad_w / np.sqrt(past_w)
        free -= rate * grad_t / np.sqrt(past_t)
    return w, free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grade, weight, text) to (grade, weight, the text's distinct features)."""
    for batch in pieces(batches, "text"):
        rows, found = features(batch.column("text"))
        order = np.lexsort((found, rows))
        rows, found = rows[order], found[order]
        first = np.ones(len(rows), bool)
        first[1:] = (rows[1:] != rows[:-1]) | (found[1:] != found[:-1])
        ends = np.searchsorted(rows[first], np.arange(batch.num_rows + 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("grade"), batch.column("weight"),
             pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(found[first].view(np.int64)))],
            ["grade", "weight", "features"])


def sample_labels(labels: DataFrame, doc_id: str, grade: str, per_class: int) -> DataFrame:
    """At most ``per_class`` toxic and as many other ids, the first by a hash of the id.

    ``weight`` is the number of labelled ids of the class that each of them stands for.
    """
    known = labels.where(F.col(grade).isNotNull() & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).alias("labelled")).agg(F.max(F.col(grade).cast("int")).alias("grade"))
    order = [F.xxhash64("labelled"), F.col("labelled")]
    both = known.agg(F.count_if(F.col("grade") > 0).alias("toxic"), F.count_if(F.col("grade") <= 0).alias("other")).first()

    def first(of: str, count: int) -> DataFrame:
        return known.where(of).orderBy(*order).limit(per_class).withColumn("weight", F.lit(max(1.0, count / per_class)))

    return first("grade > 0", both["toxic"]).unionByName(first("grade <= 0", both["other"]))


def severity_grades(toxic: np.ndarray, rows: np.ndarray, strong: np.ndarray) -> np.ndarray:
    """Grades 0 to 3 from 0/1 labels: toxic documents by terciles of their number of strong features."""
    count = np.bincount(rows, strong, len(toxic))
    cuts = np.quantile(count[toxic > 0], [1 / 3, 2 / 3])
    return np.where(toxic > 0, 1 + np.searchsorted(cuts, count, side="left"), 0)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", grade: str = "toxic",
        per_class: int = PER_CLASS, n_features: int = N_FEATURES) -> OrdinalModel | None:
    """The model of a bounded, hash-ordered sample of the labelled documents."""
    sample = sample_labels(labels, doc_id, grade, per_class)  # at most 2 * per_class rows: small enough to broadcast
    texts = docs.select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(text)).alias("text")).join(
        F.broadcast(sample), F.col("id") == F.col("labelled")).select("grade", "weight", "text")
    seen = written(texts.mapInArrow(_featurise, "grade int, weight double, features array<long>"), "labelled")
    toxic = F.col("grade") > 0
    sums = seen.agg(F.count("*").alias("n"), F.count_if(toxic).alias("toxic"), F.max("grade").alias("top"),
                    F.max(F.when(toxic, F.col("weight"))).alias("stands"), F.max(F.when(~toxic, F.col("weight"))).alias("other")).first()
    if not 0 < sums["toxic"] < sums["n"]:
        return None
    share = sums["toxic"] * sums["stands"] / (sums["toxic"] * sums["stands"] + (sums["n"] - sums["toxic"]) * sums["other"])
    counts = seen.select(toxic.cast("int").alias("toxic"), F.explode("features").alias("feature")).groupBy(
        "feature").agg(F.count("*").alias("docs"), F.sum("toxic").alias("bad")).where(F.col("docs") >= LEAST_DOCS)
    counts = counts.select("feature", (F.col("bad") * sums["stands"]).alias("hits"), (
        F.col("bad") * sums["stands"] + (F.col("docs") - F.col("bad")) * sums["other"]).alias("n"))
    departs = (F.col("hits") - F.col("n") * share) / F.sqrt(F.col("n") * (share * (1 - share)))
    chosen = counts.withColumn("departs", departs).where("departs <> 0").orderBy(
        F.abs("departs").desc(), "feature").limit(n_features).toArrow()  # at most n_features rows
    ids = chosen.column("feature").to_numpy().view(np.uint64)
    order = np.argsort(ids)
    ids = ids[order] if len(ids) else np.zeros(1, np.uint64)
    hits, n = (chosen.column(c).to_numpy()[order] for c in ("hits", "n"))

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.flatnonzero(np.isin(ids, np.array(x, np.int64).view(np.uint64), assume_unique=True))
                   for x in batch.column("features").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade"), batch.column("weight"), pa.array(own, pa.list_(pa.int64()))], ["grade", "weight", "used"])

    got = seen.mapInArrow(used, "grade int, weight double, used array<long>").toArrow()  # the sample's rows, chosen features only
    grades = np.maximum(got.column("grade").to_numpy(), 0).astype(np.int64)
    own = got.column("used").to_pylist()
    rows = np.repeat(np.arange(len(own)), [len(x) for x in own])
    cols = np.array([c for x in own for c in x], np.int64)
    if sums["top"] == 1:
        strong = (hits > n * share) & (hits >= 0.9 * n) if len(hits) else np.zeros(1, bool)
        grades = severity_grades(grades, rows, strong[cols].astype(float))
        grades = np.searchsorted(np.unique(grades), grades)  # no empty grades when counts tie
    w, cuts = fit_ordinal(rows, cols, len(ids), grades, weight=got.column("weight").to_numpy())
    return OrdinalModel(ids, w, cuts)


def score(docs: DataFrame, model: OrdinalModel | None, text: str = "text", cut: float = CUT) -> DataFrame:
    """``docs`` with severity (expected grade, double), grade (most probable, int) and toxic (boolean)."""
    def on(column: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, column):
                above = model.at_least(batch.column(column)) if model else np.zeros((batch.num_rows, 1))
                full = np.hstack([np.ones((len(above), 1)), above, np.zeros((len(above), 1))])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(above.sum(axis=1)),
                     pa.array((full[:, :-1] - full[:, 1:]).argmax(axis=1).astype(np.int32)), pa.array(above[:, 0] >= cut)],
                    [*batch.schema.names, "severity", "grade", "toxic"])
        return run

    return map_rows(docs, text, "severity double, grade int, toxic boolean", on)


def _read(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"),
            spark.read.parquet(f"{sf_dir}/labels.parquet"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir)
    return score(docs, fit(docs, labels)).drop("text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: toxic documents go. The model is fitted on the labelled documents of the folder."""
    model = fit(*_read(spark, sf_dir))
    return score(docs, model).where(~F.col("toxic")).select(*docs.columns)
