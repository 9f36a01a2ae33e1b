"""Embedding whitening from a weighted multiplicity covariance.

Vectors become integers x = floor(256 c). Identical x vectors are grouped
once, whatever their number, so a vector that a third of all rows hold is one
row from there on. A group weighs its row count in the fit or, with
``weights="one"``, one. Sums come first, so that every covariance is centred
before it is multiplied: each task multiplies its centred matrix with its
weighted copy and emits one square of numbers, and Spark adds the squares up.
The eigenvectors of that square, dimensions by dimensions whatever the number
of rows, are found on the driver. Every distinct vector is whitened once and
joined back to its rows by a 128-bit hash.

Defined results: rows with a null vector, or one that holds null or non-finite
entries, or entries whose x leaves 64 bits, take no part. So don't vectors
without entries, nor vectors whose length is not the most frequent one (the
shorter on a tie): there is no covariance across lengths. Repeated rows come
back as often as they occur, also with a null id. Components whose eigenvalue
is no more than rounding (rank below ``components``, or one distinct vector
only) cannot be whitened and are left out. A deviation that leaves 64 bits
raises an error instead of wrapping. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import quoted, written

QUERY = "op13_whitening"
ORACLE = None  # eigenvectors: held against numpy in tests/llm/test_whitening.py

SCALE = 256
COMPONENTS = 4
ROWS = 8192  # vectors that a task multiplies at a time


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x, k1, k2) of the rows that take part; k1 and k2 are two hashes of x."""
    c = F.col(quoted(embedding)).cast("array<double>")
    usable = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * SCALE) < 2.0 ** 63))
    rows = vectors.select(F.col(quoted(vec_id)).alias("vec_id"), c.alias("c")).where((F.size(c) > 0) & usable)
    x = rows.select("vec_id", F.transform("c", lambda v: F.floor(v * SCALE)).alias("x"))
    return x.select("vec_id", "x", F.xxhash64("x").alias("k1"), F.xxhash64(F.lit(1), "x").alias("k2"))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def moments(rows: DataFrame, column: str, weight: str) -> tuple[int, list, np.ndarray]:
    """(total weight, weighted sums, weighted centred covariance) of a column of equally long arrays.

    Sums are exact for integers. Two passes: sums per dimension, then one
    centred product per task. What reaches the driver is as large as the
    square of the dimensions.
    """
    kind = rows.schema[column].dataType.elementType.simpleString()
    summed = rows.select(F.col(weight).alias("w"), F.posexplode(column).alias("i", "v")).groupBy("i").agg(
        F.sum(F.col("w") * F.col("v")).alias("s"), F.sum("w").alias("n"))
    sums = sorted((r["i"], r["s"], r["n"]) for r in summed.collect())  # one row per dimension
    if not sums:
        return 0, [], np.zeros((0, 0))
    n, total = sums[0][2], [s for _, s, _ in sums]
    mean = np.array([s / n for s in total], np.float64)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square = np.zeros((len(mean), len(mean)))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                centred = matrix(part.column(0)).astype(np.float64) - mean
                square += centred.T @ (centred * part.column(1).to_numpy()[:, None])
        if square.any():
            i, j = np.nonzero(square)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(square[i, j])], ["i", "j", "v"])

    added = rows.select(F.col(column).cast(f"array<{kind}>"), F.col(weight).cast("double")).mapInArrow(
        products, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    square = np.zeros((len(mean), len(mean)))
    for r in added.collect():  # dimensions x dimensions at most
        square[r["i"], r["j"]] = r["v"]
    return n, total, (square + square.T) / 2 / n


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS,
           weights: str = "count") -> DataFrame:
    """Per row that takes part: vec_id, n, deviation, whitened and explained (arrays by component), identity_error.

    ``weights`` is what a distinct vector weighs in the fit: ``"count"`` (its
    rows) or ``"one"``. n is the total weight.
    """
    if weights not in ("count", "one"):
        raise ValueError("weights is 'count' or 'one'")
    rows = integer_vectors(vectors, vec_id, embedding)
    groups = rows.groupBy("x", "k1", "k2").agg(F.count(F.lit(1)).alias("copies"))
    groups = written(groups.withColumn("weight", F.col("copies") if weights == "count" else F.lit(1).cast("long")), "vectors")
    sizes = groups.groupBy(F.size("x").alias("d")).agg(F.sum("copies").alias("c")).orderBy(F.desc("c"), "d").first()
    fitted = groups.where(F.size("x") == (sizes["d"] if sizes else 0))
    n, total, cov = moments(fitted, "x", "weight")
    values, axes = np.linalg.eigh(cov) if n else (np.zeros(0), np.zeros((0, 0)))
    trace = float(np.trace(cov))
    order = [i for i in np.argsort(values)[::-1][:components] if values[i] > len(values) * np.finfo(float).eps * trace]
    scaled, explained = axes[:, order] / np.sqrt(values[order]), [float(values[i] / trace) for i in order]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, exact = np.array([s / n for s in total]), np.array(total, object)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = matrix(part.column("x"))
                white = (x.astype(np.float64) - mean) @ scaled
                deviation = [sum(d * d for d in row) for row in x.astype(object) * n - exact] if wide(x) else \
                    np.square(x * n - np.array(total, np.int64)).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("k1"), part.column("k2"), part.column("weight"), pa.array(deviation, pa.int64()),
                     pa.array(list(white), pa.list_(pa.float64()))], ["k1", "k2", "weight", "deviation", "whitened"])

    def wide(x: np.ndarray) -> bool:
        """Whether 64-bit arithmetic could overflow."""
        most = max(int(x.max()), -int(x.min())) * n + max(abs(s) for s in total)
        return most * most * x.shape[1] >= 2 ** 63

    done = written(fitted.mapInArrow(project, "k1 long, k2 long, weight long, deviation long, whitened array<double>"), "whitened")
    _, _, unit = moments(done, "whitened", "weight")
    error = float(np.abs(unit - np.eye(len(unit))).max()) if unit.size else 0.0
    out = rows.select("vec_id", "k1", "k2").join(done.drop("weight"), ["k1", "k2"])
    return out.select("vec_id", F.lit(int(n)).cast("long").alias("n"), "deviation", "whitened",
                      F.array(*[F.lit(e) for e in explained]).cast("array<double>").alias("explained"),
                      F.lit(error).alias("identity_error"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four components of every vector; the fit list is each distinct vector once."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    each = whiten(vectors, weights="one").select("*", F.posexplode("whitened").alias("place", "value"))
    return each.select("vec_id", (F.col("place") + 1).cast("int").alias("component"), "n", "deviation",
                       F.col("value").alias("whitened"), F.col("explained")[F.col("place")].alias("explained"), "identity_error")
