"""Periodic runs: against brute force over random, planted and awkward rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from corpus_rows import AWKWARD, docs_of, folder  # noqa: F401
from strata.llm import periodic_runs as pr


def brute_runs(words):
    """{(start, length, period)} by definition: every period, every stretch."""
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    a = np.array([ids[w] for w in words], np.int64)
    found = {}
    for q in range(1, len(a) // 4 + 1):
        same = np.concatenate([[False], a[:-q] == a[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edges[::2], edges[1::2]):
            if e - s + q >= max(6, 4 * q):
                found.setdefault((int(s), int(e - s + q)), q)  # the smallest period comes first
    return sorted((s, n, q) for (s, n), q in found.items())


def expected(text):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    runs = brute_runs(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest())


def plant(doc_id, text):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is None or h % 10 or not words:
        return text
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    return " ".join(w if i < a else words[a + (i - a) % p] for i, w in enumerate(words))


def random_texts(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        letters = rng.choice(["ab", "abc", "abcdefghij", [f"w{i}" for i in range(200)]])
        words = []
        while len(words) < rng.randint(0, 400):
            unit = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 21, 40]))]
            words += unit * rng.choice([1, 1, 2, 4, 5, 9]) + unit[:rng.randint(0, len(unit))]
        out.append(" ".join(words))
    return out


def compare(rows, got):
    want = sorted([(i, *expected(t)) for i, t in rows], key=str)
    assert sorted([tuple(r)[:8] for r in got], key=str) == want


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(docs_of, seed):
    rows = list(enumerate(random_texts(120, seed)))
    compare(rows, pr.periodic_runs(docs_of(rows)).collect())


def test_awkward_rows(docs_of):
    rows = AWKWARD + [(20, "a " * 6), (21, "a " * 5), (22, "a b " * 4), (23, "a b " * 3 + "a"), (24, ("x y z " * 9)[:-3]), (24, "other id"),
                      (25, " ".join(["a"] * 40 + ["b"] + ["a"] * 40)), (26, ("a a b " * 6 + "c ") * 8), (27, "A a " * 9)]
    got = pr.periodic_runs(docs_of(rows)).collect()
    compare(rows, got)
    assert {tuple(map(tuple, r.runs)) for r in got if r.doc_id == 8} == {((0, 30_000, 1),)}


def test_long_periods_cross_many_tiles(docs_of):
    rng = random.Random(9)
    unit = [f"u{rng.randrange(10**6)}" for _ in range(3001)]
    rows = [(1, " ".join(["head"] * 5 + unit * 4 + unit[:7] + ["tail"])), (2, " ".join(unit * 3)), (3, " ".join(unit[:700] * 30))]
    compare(rows, pr.periodic_runs(docs_of(rows)).collect())


def test_one_row_per_copy(spark):
    rows = [(5, "a b " * 50)] * 40 + [(None, "a b " * 50)] * 20
    got = pr.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    compare(rows, got)


def test_query_plants_and_finds(spark, folder):
    path = "/root/testdata/sf0.001"
    t = pq.read_table(f"{path}/documents.parquet").to_pydict()
    rows = [(i, plant(i, x)) for i, x in zip(t["doc_id"], t["text"])]
    got = pr.query(spark, path).collect()
    compare(rows, got)
    assert sum(r.n_runs > 0 for r in got) > 5


def test_strings_as_ids_and_empty_table(spark):
    df = spark.createDataFrame([("x", "a " * 9)], "doc_id string, text string")
    assert [(r.doc_id, r.length) for r in pr.periodic_runs(df).collect()] == [("x", 9)]
    assert pr.periodic_runs(df.limit(0)).collect() == []


def test_z_function():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.randrange(2) for _ in range(rng.randint(1, 30))]
        want = [next((k for k in range(len(a) - i) if a[k] != a[i + k]), len(a) - i) for i in range(len(a))]
        assert pr.z_function(a) == want
