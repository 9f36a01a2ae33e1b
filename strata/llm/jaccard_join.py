"""N-gram Jaccard join: documents whose sets of word 5-grams have a Jaccard similarity of 0.8 or more.

A size-aware heavy-light join over *classes* (documents with the same set):

* **Small sets** (up to a size chosen by cost) enumerate fixed-size subsets. Two
  sets of sizes n and m link exactly if they share ceil(4 (n + m) / 9)
  shingles, so all sets under the same (n, m, subset) key are linked: no
  candidates, no verification, and a star per key instead of pairs.
* **Large sets** scan inverted lists. A set enters the lists of its first
  n - o + 1 shingles in one global order, where o is its least possible
  overlap, so linked sets meet in some list. The order puts *heavy* shingles
  (passages and lines shared by many classes, counted over all documents)
  last, by count, so they leave the prefixes of all but the sets made of them.

Candidates of large sets come in two waves. First each list offers a star: its
best covered member with each other one. Verified links are joined to
components. Then every list that still spans two components offers all pairs
across components. Pairs inside a component cannot change the result, so a group
of thousands of near copies costs about as many pairs as it has members, and
nothing is capped or sampled. Candidates pass a lossless bitmap bound before
whole sets are compared.

Long lists are cut into blocks of at most about BLOCK members (pairs of blocks
for the second wave), so no task gathers an unbounded list. The driver holds
only the heavy shingles (at most MAX_HEAVY; the choice affects cost, never the
result) and sums.

Sets are compared by 64-bit shingle hashes, classes by a 64-bit hash of the set
and its size. Defined results: a null, empty or blank text has no shingles and
is linked with nothing (its component is its own id); repeated rows are copies
of each other; a null id counts as larger than any other; other columns play
no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import quoted, written
from .textkit import mix, pieces, ranges, shingle_hashes, word_hashes

QUERY = "op4_jaccard_join"
ORACLE = None  # tests compare with brute force

K = 5
MAX_HEAVY = 1 << 18         # heavy shingles kept in memory, the most frequent ones
HEAVY_COUNT = 32            # classes that make a shingle heavy
LOCAL_COUNT = 3             # a chunk of documents reports shingles from so many classes on
CHUNK = 2_000_000           # shingles of a chunk
MOST_SUBSETS = 20           # bound of the size up to which subsets may be enumerated
BLOCK = 1024                # members of a block of a long list
LEAST_BITS = 1024           # size of a class's parity bitmap, which grows with the set
SHORT_BITS = 512            # size of the bitmap that a class carries through the lists
MAX_BROADCAST = 1_000_000   # ids of documents to read again: broadcast up to so many, else shuffled


def need(n: int, m: int) -> int:
    """Shared shingles that link sets of sizes n and m: 100 * both >= 80 * union."""
    return -(-4 * (n + m) // 9)


def partners(n: int) -> range:
    """Sizes that a set of size n can be linked with."""
    return range(-(-4 * n // 5), 5 * n // 4 + 1)


def prefix_length(n):
    """Shingles of a set (or of an array of sizes) that must be listed to meet every partner."""
    least = -(-4 * n // 5)
    return n - -(-4 * (n + least) // 9) + 1


# ------------------------------------------------------------------ sets

def _sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all rows, one row after the other, and offsets."""
    words, first = word_hashes(texts)
    grams, at = shingle_hashes(words, first, K)
    parts = [np.unique(grams[a:b]) for a, b in zip(at, at[1:])]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), offsets


def _classes(tokens: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Size and class (a hash of set and size) of every row; class 0 only for empty sets."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens)])
    n = np.diff(offsets)
    cls = mix((sums[offsets[1:]] - sums[offsets[:-1]]) ^ (n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return n, np.where(n == 0, np.uint64(0), np.where(cls == 0, np.uint64(1), cls)).view(np.int64)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents (doc, hash, n, cls, bits), of shingles frequent in a chunk (tok, cnt), and of chunk sums."""
    def told(doc, kind, n, cls, bits, short, tok, cnt, hashed=None):
        hashed = pa.nulls(len(doc), pa.int64()) if hashed is None else hashed
        return pa.RecordBatch.from_arrays(
            [doc, hashed, pa.array(np.full(len(doc), kind, np.int32)), n, cls, bits, short, tok, cnt],
            ["doc", "hash", "kind", "n", "cls", "bits", "short_bits", "tok", "cnt"])

    def counted(parts):
        toks, cnt = np.unique(np.concatenate(parts), return_counts=True)
        often = cnt >= LOCAL_COUNT
        light = cnt[cnt < HEAVY_COUNT].astype(np.int64)
        k = int(often.sum())
        none, nones = pa.nulls(k, pa.binary()), pa.nulls(k, doc_type)
        yield told(nones, 1, pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), none, none,
                   pa.array(toks[often].view(np.int64)), pa.array(cnt[often].astype(np.int64)))
        yield told(pa.nulls(1, doc_type), 2, pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                   pa.nulls(1, pa.binary()), pa.array([int(light.sum())], pa.int64()), pa.array([int((light * light).sum())], pa.int64()))

    doc_type, kept, size, seen = None, [], 0, set()
    for batch in pieces(batches, "text"):
        doc_type = batch.column("doc").type
        tokens, at = _sets(batch.column("text"))
        n, cls = _classes(tokens, at)
        bits, short = [], []
        for i, (a, b) in enumerate(zip(at, at[1:])):
            bits.append(parity_bits(tokens[a:b]))
            short.append(parity_bits(tokens[a:b], SHORT_BITS))
            if n[i] and int(cls[i]) not in seen:
                seen.add(int(cls[i]))
                kept.append(tokens[a:b])
                size += b - a
        rows = len(n)
        yield told(batch.column("doc"), 0, pa.array(n.astype(np.int32)), pa.array(cls), pa.array(bits, pa.binary()),
                   pa.array(short, pa.binary()), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64()), batch.column("hash"))
        if size >= CHUNK:
            yield from counted(kept)
            kept, size, seen = [], 0, set()
    if kept:
        yield from counted(kept)


# ------------------------------------------------------------------ lists

def subset_keys(tokens: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(key, side) of a small set: side 0 for the smaller size of a pair of sizes, 1 for the larger, 2 if equal."""
    n = len(tokens)
    for m in partners(n):
        both = need(n, m)
        if m > most or both > min(n, m):
            continue
        chosen = np.array(list(combinations(range(n), both)), np.int64).reshape(-1, both)
        low, high = min(n, m), max(n, m)
        keys = mix(tokens[chosen].sum(axis=1, dtype=np.uint64) ^ np.uint64(low * 1000003 + high)).view(np.int64)
        side = 2 if n == m else 0 if n < m else 1
        yield from ((int(k), side) for k in keys)


def subset_rows(n: int) -> int:
    """Rows that subset enumeration writes for a set of size n."""
    return sum(comb(n, need(n, m)) for m in partners(n) if need(n, m) <= min(n, m))


def boundary(list_length: float) -> int:
    """Largest size for which enumerating subsets costs no more rows than scanning lists.

    A scan costs a row per listed shingle and per other member of its list,
    and reading both whole sets for each such member once.
    """
    best = 0
    for n in range(1, MOST_SUBSETS + 1):
        p = prefix_length(n)
        if subset_rows(n) > p * (1 + list_length) + min(1.0, p * list_length) * 2 * n:
            break
        best = n
    return best


def _listed(heavy, small: int):
    """Rows of the lists (kind 0) and of the subset keys (kind 1), once per class and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts = heavy.value
        seen: set[int] = set()
        for batch in pieces(batches, "text"):
            tokens, at = _sets(batch.column("text"))
            n, cls = _classes(tokens, at)
            if len(ids):
                place = np.minimum(np.searchsorted(ids, tokens), len(ids) - 1)
                weight = np.where(ids[place] == tokens, counts[place], 0)
            else:
                weight = np.zeros(len(tokens), np.int64)
            out, keys = [], []
            for i, (a, b) in enumerate(zip(at, at[1:])):
                if n[i] == 0 or int(cls[i]) in seen:
                    continue
                seen.add(int(cls[i]))
                t, w = tokens[a:b], weight[a:b]
                if n[i] <= small:
                    keys += [(k, s, int(cls[i]), int(n[i])) for k, s in subset_keys(t, small)]
                if n[i] * 5 >= (small + 1) * 4:
                    p = int(prefix_length(int(n[i])))
                    light = np.flatnonzero(w == 0)[:p]
                    if len(light) < p:
                        rest = np.flatnonzero(w > 0)
                        rest = rest[np.lexsort((t[rest], w[rest]))][:p - len(light)]
                        light = np.concatenate([light, rest])
                    out.append((t[light], w[light], int(cls[i]), int(n[i]), p))
            if len(seen) > 1_000_000:
                seen = set()
            if out:
                lengths = [len(x[0]) for x in out]
                c = np.repeat(np.array([x[2] for x in out], np.int64), lengths)
                w = np.concatenate([x[1] for x in out])
                salts = np.maximum(w // BLOCK, 1)
                salt = (c.view(np.uint64) >> np.uint64(20)).astype(np.int64) % salts
                yield _rows(0, np.concatenate([x[0] for x in out]).view(np.int64), salt, c,
                            np.repeat([x[3] for x in out], lengths), np.repeat([x[4] for x in out], lengths), salts)
            if keys:
                k = np.array(keys, np.int64)
                yield _rows(1, k[:, 0], k[:, 1], k[:, 2], k[:, 3], np.ones(len(k)), np.ones(len(k)))
    return run


def _rows(kind, tok, salt, cls, n, p, salts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(tok), kind, np.int32)), pa.array(tok), pa.array(salt.astype(np.int32)), pa.array(cls),
         pa.array(np.asarray(n).astype(np.int32)), pa.array(np.asarray(p).astype(np.int32)),
         pa.array(np.asarray(salts).astype(np.int32))],
        ["kind", "tok", "salt", "cls", "n", "p", "salts"])


# ------------------------------------------------------------------ candidates

def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs across components, of possible sizes and bitmaps, within runs of (tok, low, high); input is sorted by them."""
    names = ("tok", "low", "high", "cls", "comp", "n", "own")
    rest: list[np.ndarray] | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        cols.append(np.frombuffer(b"".join(batch.column("short_bits").to_pylist()), np.uint64).reshape(batch.num_rows, -1))
        if rest is not None:
            cols = [np.concatenate([a, b]) for a, b in zip(rest, cols)]
        starts = _run_starts(cols)
        last = starts[-1]
        rest = [c[last:].copy() for c in cols]
        yield from _paired([c[:last] for c in cols], starts)
    if rest is not None:
        yield from _paired(rest, np.array([0, len(rest[0])]))


def _run_starts(cols: list[np.ndarray]) -> np.ndarray:
    new = np.ones(len(cols[0]), bool)
    new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
    return np.flatnonzero(new)


def _paired(cols: list[np.ndarray], starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    _, low, high, cls, comp, n, own, bits = cols
    lengths = np.diff(starts)
    for length in np.unique(lengths):
        if length < 2:
            continue
        runs = starts[:-1][lengths == length]
        step = max(1, 1_000_000 // int(length * length))
        i, j = np.triu_indices(int(length), 1)
        for s in range(0, len(runs), step):
            a = (runs[s:s + step, None] + i[None, :]).ravel()
            b = (runs[s:s + step, None] + j[None, :]).ravel()
            ok = (comp[a] != comp[b]) & (np.minimum(n[a], n[b]).astype(np.int64) * 5 >= np.maximum(n[a], n[b]).astype(np.int64) * 4)
            ok &= (low[a] == high[a]) | (own[a] != own[b])
            a, b = a[ok], b[ok]
            apart = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
            ok = apart * 9 <= n[a].astype(np.int64) + n[b]
            x, y = cls[a[ok]], cls[b[ok]]
            if len(x):
                pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def parity_bits(tokens: np.ndarray, size: int = 0) -> bytes:
    """Bitmap of a set: bit k is the parity of its shingles whose leading bits are k; at least a bit per shingle,
    or of a given size."""
    size = size or max(LEAST_BITS, 1 << max(len(tokens) - 1, 0).bit_length())
    place = (tokens >> np.uint64(65 - size.bit_length())).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=size) & 1).astype(bool)).tobytes()


def bits_apart(x: bytes, y: bytes) -> int:
    """Bits in which two bitmaps differ, the longer folded to the length of the other."""
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = np.packbits(np.bitwise_xor.reduce(np.unpackbits(np.frombuffer(x, np.uint8)).reshape(-1, 2), axis=1)).tobytes()
    return (int.from_bytes(x) ^ int.from_bytes(y)).bit_count()


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that the parity bitmaps do not rule out.

    Bits that differ are at most the shingles that one set has alone, and
    linked sets have at most (n + m) / 9 of those.
    """
    for batch in batches:
        alone = np.array([bits_apart(x, y) for x, y in zip(
            batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist())], np.int64)
        n = batch.column("n_a").to_numpy().astype(np.int64) + batch.column("n_b").to_numpy()
        ok = pa.array(alone * 9 <= n)
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(ok) for c in ("a", "b")], ["a", "b"])


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        tokens, at = _sets(batch.column("text"))
        _, cls = _classes(tokens, at)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cls), pa.array([tokens[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())], ["cls", "tokens"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose whole sets are similar enough."""
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("tokens_a"), batch.column("tokens_b")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
            ok.append(100 * both >= 80 * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(ok, pa.bool_())) for c in ("a", "b")], ["a", "b"])


def verified(pairs: DataFrame, classes: DataFrame, keyed: DataFrame) -> DataFrame:
    """The links among candidate pairs (a, b), by the bitmap bound and then the whole sets, written."""
    info = classes.select("cls", "n", "bits")
    wide = pairs
    for side in ("a", "b"):
        wide = wide.join(info.select(F.col("cls").alias(side), F.col("n").alias(f"n_{side}"),
                                     F.col("bits").alias(f"bits_{side}")), side)
    maybe = written(wide.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(_bounded, "a long, b long"), "pairs")
    wanted = maybe.select(F.col("a").alias("cls")).union(maybe.select(F.col("b").alias("cls"))).distinct()
    docs = written(classes.join(wanted, "cls").select(F.col("first").alias("first"), F.col("cls").alias("of")), "reread")
    few = docs.count() <= MAX_BROADCAST
    ids = docs.select("first").distinct()
    texts = keyed.join(F.broadcast(ids) if few else ids, keyed["doc"].eqNullSafe(F.col("first")), "left_semi")
    sets = texts.mapInArrow(_whole_sets, "cls long, tokens binary")
    sets = written(sets.join(wanted, "cls", "left_semi").dropDuplicates(["cls"]), "sets")
    both = maybe
    for side in ("a", "b"):
        both = both.join(sets.select(F.col("cls").alias(side), F.col("tokens").alias(f"tokens_{side}")), side)
    return written(both.mapInArrow(_linked, "a long, b long"), "links")


# ------------------------------------------------------------------ components

def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node that each node of an edge reaches.

    Smallest labels spread along the edges and are followed one step further
    each round, so a chain of n nodes takes about log n rounds. Every round is
    a written table; the driver sees one count per round.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
        "node", F.least("node", "low").alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("comp").alias("near"))
        stepped = labels.join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("far"))
        after = written(stepped.join(jump, "low").select("node", "was", F.least("low", "far").alias("comp")), "labels")
        if after.where("was <> comp").isEmpty():
            return after.select("node", "comp")
        labels = after.select("node", "comp")


def _with_comp(rows: DataFrame, comps: DataFrame) -> DataFrame:
    return rows.join(comps.select(F.col("node").alias("cls"), "comp"), "cls", "left").withColumn(
        "comp", F.coalesce("comp", "cls"))


# ------------------------------------------------------------------ the join

def _small_links(keys: DataFrame) -> DataFrame:
    """Star links of the subset keys: equal sizes with the key's smallest class, else across the two sides."""
    least = keys.groupBy(F.col("tok").alias("key")).agg(
        *[F.min(F.when(F.col("salt") == s, F.col("cls"))).alias(f"least_{s}") for s in range(3)])
    met = keys.join(least, F.col("tok") == F.col("key"))
    other = (F.when(F.col("salt") == 0, F.col("least_1")).when(F.col("salt") == 1, F.col("least_0"))
             .otherwise(F.col("least_2")))
    return met.select(F.col("cls").alias("a"), other.alias("b")).where("a <> b")


def _stars(lists: DataFrame) -> DataFrame:
    """First wave: the member with the largest listed share of its prefix, with each other member of its list."""
    share = lists.groupBy("cls").agg((F.count("*") / F.max("p")).alias("share"))
    by = W.partitionBy("tok", "salt")
    best = F.max(F.struct("share", "n", "cls")).over(by)
    led = lists.join(share, "cls").select("tok", "salt", "cls", "n", "share").withColumn("best", best)
    fits = F.least("n", "best.n") * 5 >= F.greatest("n", "best.n") * 4
    return led.where(fits & (F.col("cls") != F.col("best.cls"))).select(
        F.least("cls", "best.cls").alias("a"), F.greatest("cls", "best.cls").alias("b")).distinct()


def _across(lists: DataFrame, comps: DataFrame, classes: DataFrame) -> DataFrame:
    """Second wave: all pairs across components, list by list, long lists by pairs of blocks."""
    rows = written(_with_comp(lists.select("tok", "cls", "n"), comps), "listed-components")
    split = rows.groupBy("tok").agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.count("*").alias("c")).where(
        "least <> most").select("tok", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks"))
    met = rows.join(split, "tok").join(classes.select("cls", "short_bits"), "cls").withColumn("own", F.pmod(F.hash("cls"), F.col("blocks")))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("tok", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                     "cls", "comp", "n", "own", "short_bits")
    sorted_ = met.repartition("tok", "low", "high").sortWithinPartitions("tok", "low", "high")
    return sorted_.mapInArrow(_cross, "a long, b long").distinct()


def _placed(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """A row per row of ``docs`` (doc, hash of the text, n, cls), and a row per class (cls, its first id, comp)."""
    spark = docs.sparkSession
    keyed = docs.select(F.col(quoted(doc_id)).alias("doc"), F.col(quoted(text)).alias("text"))
    kind = keyed.schema["doc"].dataType.simpleString()
    told = written(keyed.withColumn("hash", F.xxhash64("text")).mapInArrow(
        _profile, f"doc {kind}, hash long, kind int, n int, cls long, bits binary, short_bits binary, tok long, cnt long"), "profile")
    own = told.where("kind = 0")
    classes = written(own.where("n > 0").groupBy("cls", "n").agg(
        F.min("doc").alias("first"), F.any_value("bits").alias("bits"),
        F.any_value("short_bits").alias("short_bits")), "classes")
    sums = told.where("kind = 2").agg(F.sum("tok"), F.sum("cnt")).first()
    heavy = told.where("kind = 1").groupBy("tok").agg(F.sum("cnt").alias("c")).where(F.col("c") >= HEAVY_COUNT)
    heavy = heavy.orderBy(F.desc("c"), "tok").limit(MAX_HEAVY).toArrow()  # at most MAX_HEAVY rows of 16 bytes
    ids, counts = heavy.column("tok").to_numpy().view(np.uint64), heavy.column("c").to_numpy()
    order = np.argsort(ids)
    shared = spark.sparkContext.broadcast((ids[order], counts[order]))
    small = boundary(sums[1] / sums[0] - 1 if sums[0] else 0.0)

    listed = keyed.mapInArrow(_listed(shared, small), "kind int, tok long, salt int, cls long, n int, p int, salts int")
    dealt = listed.repartition("tok", "salt").dropDuplicates(["kind", "tok", "salt", "cls"])
    met = F.count("*").over(W.partitionBy("tok", "salt"))
    rows = written(dealt.withColumn("met", met).where("kind = 1 OR met > 1 OR salts > 1"), "lists")
    lists = rows.where("kind = 0")

    links = written(verified(_stars(lists), classes, keyed).union(_small_links(rows.where("kind = 1"))), "links")
    comps = components(links)
    more = verified(_across(lists, comps, classes), classes, keyed)
    raised = more
    for side in ("a", "b"):
        raised = raised.join(comps.select(F.col("node").alias(side), F.col("comp").alias(f"comp_{side}")), side, "left")
    raised = raised.select(*[F.coalesce(f"comp_{s}", s).alias(s) for s in ("a", "b")]).where("a <> b").distinct()
    joined = components(raised).withColumnRenamed("comp", "top").withColumnRenamed("node", "comp")
    placed = _with_comp(classes.select("cls", "first"), comps).join(joined, "comp", "left").select(
        "cls", "first", F.coalesce("top", "comp").alias("comp"))
    return own.select("doc", "hash", "n", "cls"), placed


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc, n_shingles, cls (its class; null without shingles) and component_id."""
    own, placed = _placed(docs, doc_id, text)
    lowest = placed.groupBy("comp").agg(F.min("first").alias("component_id"))
    of_class = placed.join(lowest, "comp").select(F.col("cls").alias("of"), "component_id")
    return own.join(of_class, (F.col("cls") == F.col("of")) & (F.col("n") > 0), "left").select(
        "doc", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("cls")).alias("cls"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_join(docs).select(F.col("doc").alias("doc_id"), "n_shingles", "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of every group of linked documents one row with the smallest id stays.

    Groups are told apart by their classes, not by ids: unlinked texts that
    share an id, or have none, all stay. Rows without shingles are linked with
    nothing, so each of them stays.
    """
    own, placed = _placed(docs, "doc_id", "text")
    least = placed.groupBy("comp").agg(F.min(F.struct(F.col("first").isNull(), "first", "cls")).alias("least"))
    least = least.select(F.col("least.cls").alias("of_cls"), F.col("least.first").alias("of_first"))
    chosen = own.where("n > 0").join(least, (F.col("cls") == F.col("of_cls")) & F.col("doc").eqNullSafe(F.col("of_first")))
    chosen = chosen.groupBy("cls", "doc").agg(F.min("hash").alias("of_hash"), F.count("*").alias("copies")).select(
        F.col("doc").alias("of_doc"), "of_hash", "copies")
    alone = own.where("n = 0").select(F.col("doc").alias("of_doc"), F.col("hash").alias("of_hash"), F.lit(1).cast("long").alias("copies"))
    kept = written(chosen.union(alone.distinct()), "kept")
    few = kept.count() <= MAX_BROADCAST
    once = docs.withColumn("own_hash", F.xxhash64("text")).join(
        F.broadcast(kept) if few else kept, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("own_hash") == F.col("of_hash")))
    again = once.where("copies > 1").dropDuplicates(["doc_id", "own_hash"]).select(*docs.columns)
    return once.where("copies = 1").select(*docs.columns).unionByName(again)
