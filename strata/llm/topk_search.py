"""Exact top-k search over an impact-ordered, score-at-a-time index.

Vectors become integers, floor(256 x). The index holds blocks of vectors; a
block's postings (dimension, vector, value) are ordered by quantised impact:
segment by segment, the postings whose magnitude falls into one quantisation
step, largest first. A query block reads a vector block's segments in that
order and keeps, for each query and vector, the score so far and a bound on
what is missing: half a step per posting read, the size of the next segment per
posting not read yet, each times the query's weight.

It stops only on proof: when the k-th greatest lower bound leaves no more than
``FEW`` possible members per query, or when every segment is read. All possible
members are then scored exactly from the whole vectors, so the result is exact
whenever it stops. Blocks keep their k best; a partial top-k before the
shuffle merges blocks.

Work is dealt by (query block, vector block), both of fixed size, so no task
holds more than one of each whatever the table's size, and no vector is hotter
than another. Each query block meets each vector block once.

Defined results: rows with a null id, a null vector, or a null or non-finite
component take no part; an empty vector scores 0 with everything; a shorter
vector counts as padded with zeros; repeated ids count once, with their
smallest vector. Ties go to the smaller id. Scores that leave 64 bits raise an
error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import quoted, written

QUERY = "op3_topk_search"

K = 5
SCALE = 256
QUERY_BLOCK, VECTOR_BLOCK = 512, 4096
STEPS = 12   # segments by magnitude
FEW = 64     # possible members per query at which reading on costs more than scoring them


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """id and integer vector of the rows that take part, one per id."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col(quoted(vec_id)).cast("long").alias("id"),
                          F.col(quoted(embedding)).cast("array<double>").alias("v"))
    kept = kept.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(F.coalesce(finite, F.lit(False)))
    ints = kept.select("id", F.transform("v", lambda x: F.floor(x * SCALE)).alias("v"))
    return ints.groupBy("id").agg(F.min("v").alias("v"))


def _matrix(lists: pa.Array) -> np.ndarray:
    """Lists of integers as rows, padded with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(np.asarray(lists.offsets)) if len(lists) else np.zeros(0, np.int64)
    out = np.zeros((len(lists), int(sizes.max()) if len(sizes) else 0), np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class ImpactIndex:
    """Postings of one block of vectors in segments of descending magnitude."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, steps: int = STEPS):
        order = np.argsort(ids)
        self.ids, self.vectors = ids[order], vectors[order]
        size = np.abs(self.vectors)
        self.step = max(1, -(-int(size.max(initial=0) + 1) // steps))
        level = (size // self.step).T  # dimension by vector
        flat = np.argsort(-level, axis=None, kind="stable")
        self.dims, self.members = np.unravel_index(flat, level.shape)
        edges = np.searchsorted(-level.ravel()[flat], -np.arange(level.max(initial=0), -2, -1), side="left")
        self.segments = [(int(v), int(a), int(b)) for v, a, b in zip(
            range(int(level.max(initial=0)), -1, -1), edges, edges[1:])]
        self.signs = np.sign(self.vectors.T)[self.dims, self.members]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, few: int = FEW) -> tuple[list, int]:
        """(query, id, score) of every query's k best in the block, and how many segments were read."""
        if len(self.ids) == 0 or len(query_ids) == 0:
            return [], 0
        wide = max(queries.shape[1], self.vectors.shape[1])
        q = np.pad(queries, ((0, 0), (0, wide - queries.shape[1]))).astype(np.float64)
        v = np.pad(self.vectors, ((0, 0), (0, wide - self.vectors.shape[1])))
        n = len(self.ids)
        own = self.ids[None, :] == query_ids[:, None]
        score = np.zeros((len(q), n))
        weight = np.abs(q)
        missing = np.full((wide, n), 0.0)
        missing[self.dims, self.members] = (self.segments[0][0] + 1) * self.step  # nothing is read yet
        possible, read = ~own, 0
        for level, a, b in self.segments:
            d, m = self.dims[a:b], self.members[a:b]
            part = np.zeros((wide, n))
            part[d, m] = self.signs[a:b] * ((level + 0.5) * self.step)
            score += q @ part
            missing[d, m] = self.step / 2
            later = slice(b, None)
            missing[self.dims[later], self.members[later]] = level * self.step  # at most this is left of each
            read += 1
            last = level == 0
            if not last and level > self.segments[0][0] // 2:
                continue  # bounds are too wide to prove anything yet
            bound = weight @ missing
            bound += 1e-9 * (np.abs(score) + bound)  # rounding of the sums
            low = np.where(own, -np.inf, score - bound)
            kth = np.partition(low, n - k, axis=1)[:, n - k] if n > k else np.full(len(q), -np.inf)
            possible = (score + bound >= kth[:, None]) & ~own
            if last or possible.sum() <= few * len(q):
                break
        rows, places = np.nonzero(possible)
        exact = self._exact(queries, v, rows, places)
        order = np.lexsort((places, -exact, rows))  # ids ascend with places
        rows, places, exact = rows[order], places[order], exact[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        best = rank < k
        return [(query_ids[rows[best]], self.ids[places[best]], exact[best])], read

    @staticmethod
    def _exact(queries: np.ndarray, v: np.ndarray, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        q = np.pad(queries, ((0, 0), (0, v.shape[1] - queries.shape[1])))
        most = int(np.abs(q).max(initial=0)) * int(np.abs(v).max(initial=0)) * max(v.shape[1], 1)
        if most >= 1 << 63:
            got = [sum(int(x) * int(y) for x, y in zip(q[i], v[j])) for i, j in zip(rows, places)]
            return np.array(got, np.int64)  # raises if a score does not fit
        out = np.empty(len(rows), np.int64)
        for s in range(0, len(rows), 1 << 18):
            out[s:s + (1 << 18)] = np.einsum("ij,ij->i", q[rows[s:s + (1 << 18)]], v[places[s:s + (1 << 18)]])
        return out


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def topk_search(vectors: DataFrame, queries: DataFrame, k: int = K, vec_id: str = "vec_id",
                embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``vectors`` for every row of ``queries``, but its own id."""
    rows, asked = written(usable(vectors, vec_id, embedding), "vectors"), written(usable(queries, vec_id, embedding), "asked")
    blocks = max(1, -(-rows.count() // VECTOR_BLOCK))
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    index = rows.withColumn("v_block", F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn(
        "q_block", F.explode(_numbers(query_blocks)))
    blocked = asked.withColumn("q_block", F.pmod(F.xxhash64("id"), F.lit(query_blocks))).withColumn(
        "v_block", F.explode(_numbers(blocks)))

    def run(ids: pa.Table, asked_: pa.Table) -> pa.Table:
        block = ImpactIndex(ids.column("id").to_numpy(), _matrix(ids.column("v")))
        found, _ = block.search(asked_.column("id").to_numpy(), _matrix(asked_.column("v")), k)
        parts = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (pa.array(x, pa.int64()) for x in parts))))

    best = index.groupBy("q_block", "v_block").cogroup(blocked.groupBy("q_block", "v_block")).applyInArrow(
        run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return topk_search(vectors, vectors.where(F.col("vec_id") % 50 == 0))


ORACLE = f"""
WITH v AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.id AS query_id, c.id AS vec_id,
         list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS score
  FROM v q JOIN v c ON q.id % 50 = 0 AND c.id <> q.id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= {K}
"""
