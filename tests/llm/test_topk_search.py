"""Exact top-k search against brute force, with ties, repeats, odd vectors, and small blocks."""

import math
import random

import numpy as np

from strata.llm import topk_search as t


def brute(rows, k):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            w = [math.floor(256 * x) for x in v]
            ok[i] = min(ok.get(i, w), w)
    out = []
    for q in ok:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(ok[q], ok[c])), c) for c in ok if c != q)[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    return sorted(out)


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(t, "VECTOR_BLOCK", 64)
    monkeypatch.setattr(t, "QUERY_BLOCK", 4)
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(400)]
    rows += [(400 + i, rows[3][1]) for i in range(60)]  # a very common vector: ties
    rows += [(0, rows[0][1]), (None, rows[1][1]), (900, None), (901, [1.0, None]), (902, [float("nan")]), (903, [float("inf")]),
             (950, []), (951, [0.5, -0.5]), (1000, [0.0] * 8), (1050, [3.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = t.topk_search(df, df.where("vec_id % 50 = 0")).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(rows, 5)


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(50, [1.0]), (51, [2.0]), (100, [-1.0])], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in t.topk_search(df, df.where("vec_id % 50 = 0")).collect())
    assert got == [(50, 1, 51, 131072), (50, 2, 100, -65536), (100, 1, 50, -65536), (100, 2, 51, -131072)]
    assert t.topk_search(df.where("false"), df.where("false")).count() == 0


def test_stops_early_only_with_the_whole_answer():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-40, 40, (500, 16))
    vectors[::100] *= 8  # a few rows stand out: proof comes before the last segment
    index = t.ImpactIndex(np.arange(500), vectors)
    queries = np.abs(rng.integers(-200, 200, (3, 16))) * np.sign(vectors[100])
    found, read = index.search(np.array([9000, 9001, 9002]), queries, 1, few=1)
    score = queries @ vectors.T
    want = [(q, c, score[q, c]) for q in range(3) for c in sorted(range(500), key=lambda c: (-score[q, c], c))[:1]]
    assert [(q - 9000, c, s) for q, c, s in zip(*found[0])] == want and read < len(index.segments)
