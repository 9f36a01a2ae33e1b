"""Frequent itemsets and product candidates: against brute-force supports, big baskets, empty input."""

import random
from collections import Counter
from datetime import datetime
from itertools import combinations

from strata.operators import brief as B
from strata.operators import silver as S

ITEMS, ORDERS = "order_id long, product_id long", "order_id long, customer_id long"


def baskets(rows):
    out = {}
    for o, p in rows:
        if o is not None and p is not None:
            out.setdefault(o, set()).add(p)
    return out


def test_supports_of_pairs_and_triples(spark):
    rng = random.Random(3)
    rows = [(o, min(rng.randrange(1, 40), rng.randrange(1, 40))) for o in range(300) for _ in range(rng.randint(1, 6))]
    rows += [(999, p) for p in range(200)] + [(None, 3), (5, None), (5, 1), (5, 1)]  # one giant order, NULLs, repeats
    want = Counter()
    for own in baskets(rows).values():
        for k in (1, 2, 3):
            want.update(combinations(sorted(p for p in own if p < 40), k))
    df = spark.createDataFrame(rows, ITEMS)
    for least in (2, 5, 40):
        got = {tuple(r["items"]): r.n_orders for r in B.frequent_itemsets(df, least).collect()}
        assert got == {s: n for s, n in want.items() if n >= least}, least


def test_candidates_are_new_to_the_customer(spark):
    rng = random.Random(4)
    rows = [(o, rng.randrange(15)) for o in range(120) for _ in range(3)]
    orders = [(o, o % 20 if o % 17 else None) for o in range(120)]
    own = baskets(rows)
    one, two = Counter(), Counter()
    for b in own.values():
        one.update(b)
        two.update((x, y) for x in b for y in b if x != y)
    bought = {}
    for o, c in orders:
        if c is not None:
            bought.setdefault(c, set()).update(own.get(o, ()))
    want = {}
    for c, have in bought.items():
        for cand in set(range(15)) - have:
            offers = [(two[x, cand] / one[x], two[x, cand], -x) for x in have if two[x, cand] >= 3 and two[x, cand] / one[x] >= 0.1]
            if offers:
                conf, n, x = max(offers)
                want[c, cand] = (-x, n, conf)
    got = B.product_candidates(spark.createDataFrame(rows, ITEMS), spark.createDataFrame(orders, ORDERS), 3, 0.1).collect()
    assert {(r.customer_id, r.candidate): (r.because, r.n_orders, r.confidence) for r in got} == want and want


def test_nothing_to_find(spark):
    empty = spark.createDataFrame([], ITEMS)
    assert B.frequent_itemsets(empty, 2).collect() == []
    assert B.product_candidates(empty, spark.createDataFrame([], ORDERS), 2).collect() == []


def test_large_sets_of_equal_orders_are_never_formed(spark):
    """Equal orders of 70 products: 2**70 sets are frequent, those of up to 3 products are found all the same."""
    rows = [(o, p) for o in (1, 2) for p in range(70)] + [(3, p) for p in range(60, 130)] + [(3, 60)]
    got = {tuple(r["items"]): r.n_orders for r in B.frequent_itemsets(spark.createDataFrame(rows, ITEMS), 2).collect()}
    assert len(got) == 70 + 70 * 69 // 2 + 70 * 69 * 68 // 6
    assert got[(60,)] == got[(60, 61)] == got[(60, 65, 69)] == 3 and got[(0,)] == got[(0, 69)] == got[(0, 1, 69)] == 2


def test_pairs_of_giant_groups_come_once(spark):
    groups = spark.createDataFrame([(1, [7, 3, 5, 1, 9, 2, 8]), (2, [4]), (3, [6, 5])], "o long, items array<long>")
    for block in (1, 2, 3, 64):
        got = sorted((r.o, r.x, r["__next"]) for r in B._pairs(groups, ["o"], "x", block).collect())
        assert got == sorted([(1, *c) for c in combinations([1, 2, 3, 5, 7, 8, 9], 2)] + [(3, 5, 6)]), block


def test_candidates_from_large_equal_orders(spark):
    rows = [(o, p) for o in (1, 2, 3) for p in range(60)] + [(4, 0)]
    orders = [(1, 10), (2, 10), (3, 11), (4, 12)]
    got = B.product_candidates(spark.createDataFrame(rows, ITEMS), spark.createDataFrame(orders, ORDERS), 2).collect()
    assert {(r.customer_id, r.candidate): (r.because, r.n_orders, r.confidence) for r in got} == {
        (12, p): (0, 3, 0.75) for p in range(1, 60)}


def test_items_are_read_once_and_offers_are_not_sorted_to_find_the_best(spark, tmp_dir):
    """Purchases come from the baskets stored for the rules, and a candidate's best rule is a least rank, not a struct."""
    rows = [(o, p) for o in (1, 2, 3) for p in (1, 2, 3)] + [(4, 1), (5, 2), (5, None), (None, 1)]
    spark.createDataFrame(rows, ITEMS).write.parquet(f"{tmp_dir}/items")
    orders = spark.createDataFrame([(1, 10), (2, 10), (3, 10), (4, 11), (4, 12), (4, 11), (5, 12), (5, None)], ORDERS)
    df = B.product_candidates(spark.read.parquet(f"{tmp_dir}/items"), orders, 2)
    assert not [f for f in df.inputFiles() if f"{tmp_dir}/items" in f]
    assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.customer_id, r.candidate, r.because, r.n_orders, r.confidence) for r in df.collect())
    assert got == [(11, 2, 1, 3, 0.75), (11, 3, 1, 3, 0.75), (12, 3, 1, 3, 0.75)]


def test_best_rule_by_confidence_then_orders_then_name(spark):
    """Names as products: c goes with a in 2 of 4 orders, with b in 2 of 2, with d in 2 of 2, with e in 3 of 3."""
    sets = ["abc", "abcd", "acde", "a"]
    rows = [(f"o{i}", p) for i, s in enumerate(sets) for p in s] + [(f"e{i}", p) for i in range(2) for p in "ce"]
    have = {"x": "ab", "y": "bd", "z": "de", "w": "a"}
    rows += [(f"own-{c}", p) for c, s in have.items() for p in s]
    orders = [(f"own-{c}", c) for c in have]
    kinds = "order_id string, product_id string", "order_id string, customer_id string"
    own = baskets(rows)
    one = Counter(p for b in own.values() for p in b)
    two = Counter((x, y) for b in own.values() for x in b for y in b if x != y)
    want = {}
    for c, s in have.items():
        for cand in set("abcde") - set(s):
            offers = [(-two[p, cand] / one[p], -two[p, cand], p) for p in s if two[p, cand] >= 2]
            if offers:
                conf, n, p = min(offers)
                want[c, cand] = (p, -n, -conf)
    got = B.product_candidates(spark.createDataFrame(rows, kinds[0]), spark.createDataFrame(orders, kinds[1]), 2).collect()
    assert {(r.customer_id, r.candidate): (r.because, r.n_orders, r.confidence) for r in got} == want and len(got) == len(want) > 5


def test_products_by_order_are_those_of_the_clean_items(spark):
    rng = random.Random(5)
    some = [None, *(datetime(2024, 1, d) for d in (1, 2, 3))]
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, 1, 2, 3]), rng.choice([None, *range(6)]), rng.choice([None, 1, 2]),
             rng.choice(some), rng.choice([None, 1.0, 2.0])) for _ in range(900)]
    df = spark.createDataFrame(rows, "order_id long, order_item_id int, product_id long, seller_id long, "
                                     "shipping_limit_date timestamp, price double")
    want = S.clean_order_items(df).where("order_id is not null").select("order_id", "product_id")
    got = S.products_by_order(df)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
