"""Embedding whitening: against numpy over whole tables, awkward rows, both weights."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pytest

from corpus_rows import folder  # noqa: F401
from strata.llm import whitening as wh


def brute(rows, components=4, by_count=False):
    """{vec_id: (n, deviation, whitened)}, explained, of rows (id, entries)."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    xs = [(i, tuple(int(np.floor(256 * float(c))) for c in v)) for i, v in kept]
    counts = Counter(x for _, x in xs)
    w = np.array([c if by_count else 1 for c in counts.values()], float)
    m = np.array(list(counts), float)
    n = int(w.sum())
    sums = [sum(int(a) * int(k) for a, k in zip(w, col)) for col in zip(*counts)]
    mean = np.array([s / n for s in sums])
    cov = (m - mean).T @ ((m - mean) * w[:, None]) / n
    e, a = np.linalg.eigh(cov)
    order = np.argsort(e)[::-1][:components]
    out = [(i, n, sum((n * c - s) ** 2 for c, s in zip(x, sums)), (np.array(x) - mean) @ a[:, order] / np.sqrt(e[order])) for i, x in xs]
    return out, e[order] / np.trace(cov)


def agree(got, want, explained):
    """``got``: rows of the operator, ``want``: as ``brute`` has them; signs are free, but the same for all rows."""
    assert len(got) == len(want)
    key = lambda r: (r[0] is not None, r[0], r[2], sorted(np.abs(r[3])))
    a = sorted(((r.vec_id, r.n, r.deviation, np.array(r.whitened)) for r in got), key=key)
    b = sorted(want, key=key)
    assert [x[:3] for x in a] == [x[:3] for x in b]
    left, right = np.array([x[3] for x in a]), np.array([x[3] for x in b])
    sign = np.sign((left * right).sum(axis=0))
    assert np.allclose(left, right * sign, rtol=1e-6, atol=1e-8)
    for r in got:
        assert np.allclose(r.explained, explained, rtol=1e-9) and r.identity_error < 1e-6


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whole_table_against_numpy(spark, weights):
    path = "/root/testdata/sf0.01/embeddings.parquet"
    t = ds.dataset(path).to_table()
    rows = list(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist()))
    rows += rows[:200] * 3  # copies
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    agree(wh.whiten(df, weights=weights).collect(), *brute(rows, by_count=weights == "count"))


def test_awkward_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(c) for c in rng.normal(size=6)]) for i in range(50)]
    good += [(None, good[0][1]), (7, good[7][1]), (60, [-0.0, 0.0, -1e-9, 1.0, 2.0, 3.0])]
    odd = [(70, None), (71, []), (72, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (73, [float("nan")] * 6), (74, [float("inf")] * 6),
           (75, [1e300] * 6), (76, [1.0, 2.0])]
    df = spark.createDataFrame(good + odd, "vec_id long, embedding array<double>").selectExpr(
        "*", "1 AS n", "2 AS x", "3 AS k1", "4 AS whitened", "5 AS `a.b`")
    agree(wh.whiten(df, weights="one").collect(), *brute(good))
    big = [(i, [c * 1e12 for c in v]) for i, v in good[:9]]  # the deviation leaves 64 bits
    with pytest.raises(Exception):
        wh.whiten(spark.createDataFrame(big, "vec_id long, embedding array<double>")).collect()


def test_empty_and_flat_tables(spark):
    kind = "vec_id long, embedding array<double>"
    assert wh.whiten(spark.createDataFrame([], kind)).collect() == []
    flat = wh.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind), weights="one").collect()
    assert sorted((r.vec_id, r.n, r.deviation, r.whitened) for r in flat) == [(1, 1, 0, []), (2, 1, 0, [])]
    line = wh.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(5)], kind)).collect()
    assert {len(r.whitened) for r in line} == {1} and abs(line[0].explained[0] - 1) < 1e-12


def test_query_columns(spark, folder):
    rng = np.random.default_rng(1)
    vectors = [[float(c) for c in v] for v in rng.normal(size=(40, 8))]
    t = pa.table({"vec_id": pa.array(range(40), pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": pa.array([0] * 40)})
    got = wh.query(spark, folder(embeddings=t))
    assert got.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
                          ("explained", "double"), ("identity_error", "double")]
    rows = got.collect()
    assert len(rows) == 160 and {r.component for r in rows} == {1, 2, 3, 4}
    by = {c: {round(r.explained, 12) for r in rows if r.component == c} for c in range(1, 5)}
    assert all(len(s) == 1 for s in by.values()) and sorted((min(s) for s in by.values()), reverse=True) == [min(by[c]) for c in range(1, 5)]
