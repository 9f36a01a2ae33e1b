"""Jaccard join against brute force: components of random, planted and awkward texts, subsets and bounds."""

import random
from itertools import combinations

import numpy as np
import pytest

from corpus_rows import AWKWARD, docs_of  # noqa: F401
from strata.llm import jaccard_join as j


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                group[find(b)] = find(a)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if sets[i] and doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(s), least.get(find(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))]


def near_copies(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(40):
        rows.append([rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 6, 8, 9, 12, 20, 60, 150]))])
    for i in range(120):
        copy = list(rng.choice(rows[:40]))
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        rows.append(copy)
    hub = [rng.choice(vocabulary) for _ in range(120)]
    for i in range(60):  # a large group of near copies around one text
        copy = list(hub)
        for _ in range(rng.randint(1, 4)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
        rows.append(copy)
    for i in range(50):  # a passage that unrelated documents share
        own = [f"u{rng.randrange(10**6)}" for _ in range(rng.choice([5, 40, 100]))]
        rows.append(own + passage)
    return [(i * 3 + 1, " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("small", [None, 0, 14])
def test_components_match_brute_force(docs_of, monkeypatch, small):
    if small is not None:  # the cost picks the boundary; the result must not depend on it
        monkeypatch.setattr(j, "boundary", lambda x: small)
    monkeypatch.setattr(j, "HEAVY_COUNT", 8)
    monkeypatch.setattr(j, "BLOCK", 16)
    rows = near_copies(5 if small is None else small) + AWKWARD
    got = [(r.doc, r.n_shingles, r.component_id) for r in j.jaccard_join(docs_of(rows)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_empty_and_blank_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert j.jaccard_join(none).count() == 0
    blank = spark.createDataFrame([(1, ""), (2, None), (3, " ")], "doc_id long, text string")
    assert sorted((r.doc, r.component_id) for r in j.jaccard_join(blank).collect()) == [(1, 1), (2, 2), (3, 3)]


def test_subset_keys_meet_exactly_when_sets_link():
    rng = random.Random(2)
    for _ in range(300):
        universe = [np.uint64(x) for x in rng.sample(range(10**6), 12)]
        a = np.array(sorted(rng.sample(universe, rng.randint(1, 9))), np.uint64)
        b = np.array(sorted(rng.sample(universe, rng.randint(1, 9))), np.uint64)
        keys_a, keys_b = (set(j.subset_keys(x, 9)) for x in (a, b))
        other = {0: 1, 1: 0, 2: 2}  # a key links the two sides of a pair of sizes
        met = any((k, other[side]) in keys_b for k, side in keys_a)
        both = len(set(a.tolist()) & set(b.tolist()))
        assert met == (100 * both >= 80 * (len(a) + len(b) - both))


def test_bitmap_bound_never_rules_out_a_link():
    rng = np.random.default_rng(3)
    for n in (5, 100, 900, 1100, 3000):
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[: int(len(x) * 0.9)], rng.integers(0, 1 << 63, n // 12).astype(np.uint64)]))
        alone = len(np.setxor1d(x, y))
        assert j.bits_apart(j.parity_bits(x), j.parity_bits(y)) <= alone


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201)]
    got = {r.node: r.comp for r in j.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30)) and got[201] == 200


def test_stage_keeps_one_of_each_group(spark):
    text = " ".join(f"t{i}" for i in range(50))
    docs = spark.createDataFrame([(5, text), (3, text + " more"), (9, "other words entirely"), (9, "other words entirely"),
                                  (None, "alone without an id"), (7, "")], "doc_id long, text string")
    out = j.stage(spark, docs, "")
    assert sorted((r.doc_id or 0 for r in out.collect())) == [0, 3, 7, 9] and out.columns == docs.columns


def brute_stage(rows):
    """Texts that may stay for each group: of its rows with the smallest id, one; of rows without shingles, all."""
    ids = [(i, text) for i, (_, text) in enumerate(rows)]  # ids of their own tell the groups apart
    groups = {}
    for (doc, text), (_, n, group) in zip(rows, brute(ids)):
        groups.setdefault(("row", group) if n else ("alone", len(groups)), []).append((doc, text))
    return [{x for x in group if x[0] == min((d for d, _ in group if d is not None), default=None)} for group in groups.values()]


def test_stage_matches_brute_force(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, None, i % 25]), text) for i, (_, text) in enumerate(near_copies(6))] + AWKWARD
    text = " ".join(f"t{i}" for i in range(50))
    rows += [(None, ""), (None, "   "), (7, ""), (7, ""), (900, text), (901, text + " more"), (900, text + " less"),
             (901, "another text of the same id"), (None, text), (902, "Same WORDS here"), (902, "same words  here")]
    docs = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, place int")
    out = j.stage(spark, docs, "")
    assert out.columns == docs.columns
    left = [(r.doc_id, r.text) for r in out.collect()]
    want = brute_stage(rows)
    assert len(left) == len(want)
    for choice in sorted(want, key=len):  # sets of one first; groups share no texts with shingles
        left.remove(next(x for x in left if x in choice))
    assert not left
