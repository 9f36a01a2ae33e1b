"""Periodic run detection, distributed by scale.

A run is a longest stretch of consecutive words with smallest period q, at
least ``LEAST`` words and ``EXPONENT`` periods long. Periods are searched per
octave, s <= q < 2s. A document is cut into overlapping tiles per octave: one
boundary every s words, the tile from s words before it to 3s + GRAM words
after it. A run of the octave covers, at some boundary b, the words b to b + 3q,
and a run that leaves a tile covers the next tile's boundary with a period and a
gram. So a tile matters only if the gram at b comes again q words on, and only
beside a boundary from which on almost 3q words do (comparisons of hashes, one
per word and octave, find them). Of a long run, tiles within give way to one link. The
others alone become rows and are dealt evenly over the cluster, a long
document's tiles too.

Every tile is solved alone: the Z-function from its boundary on tells how
far the words repeat q words later, the Z-function of the reversed tile how
far they do before the boundary. That gives, per period, one fragment of a
run, cut off at the tile's ends. A cut fragment goes on in the next tile, which
overlaps it by a period at least: fragments are shuffled by document and period,
and those that overlap by a period are one interval. Intervals that are
long enough are runs; of equal intervals the smallest period counts (by the
periodicity lemma the others are its multiples).

Words are compared by 64-bit hashes. Rows are joined with their runs by a
128-bit key of id and text; only rows with tiles are shuffled.

Defined results: a null, empty or blank text has no words and no runs. Rows
of equal id and text get the same result, each its own row; null ids too. An
empty table gives no rows. Columns other than id and text are not returned.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import row_keys, written
from .textkit import NOT_BLANK, pieces, powers, row_counts, shingle_hashes, span_hashes, text_bytes, word_spans

QUERY = "op11_periodic_runs"
ORACLE = None  # no checksum function in SQL: held against brute force in tests/llm/test_periodic_runs.py

LEAST = 6      # words of a run
EXPONENT = 4   # periods of a run
GRAM = 4       # words that must come again a period later, at a boundary of small octaves
LONG_GRAM = 8  # the same from octave LONG_GRAM / 2 on

TILES = "k1 long, k2 long, octave int, boundary int, first int, codes binary"
RESULT = ("doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def smallest_factors(n: int) -> np.ndarray:
    """The smallest prime factor of every number up to n (of 0 and 1: themselves)."""
    out = np.arange(n + 1)
    for p in range(2, int(n ** 0.5) + 1):
        if out[p] == p:
            own = out[p * p::p]
            own[own == np.arange(p * p, n + 1, p)] = p
    return out


def hot_tiles(words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per octave s: rows and boundaries (from the row's first word) of the tiles that may hold an end of a run, and links.

    ``words``: hashes of all words, ``first``: where each row's words begin.
    A boundary whose gram comes again after q words is a candidate. At one of
    the first s words of a run even m = max(LEAST - 1, 3 q) - s + 1 words do,
    which the hashes of both stretches tell: a strong candidate, unless the
    stretch has a period that divides q. Candidates stay if they are linked to a
    strong one by candidates of the same period at boundaries in a row. Where
    strong ones follow each other, those between the first and the last are one
    link (row, q, start, end): all their words repeat.
    """
    n = np.diff(first)
    up, down = powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:len(words)], out=sums[1:])

    def same(x: np.ndarray, y: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Whether the m words from x on equal those from y on."""
        return (sums[x + m] - sums[x]) * down[x] == (sums[y + m] - sums[y]) * down[y]

    s = 1
    while s * EXPONENT <= n.max(initial=0):
        g = LONG_GRAM if 2 * s >= LONG_GRAM else GRAM
        gram, offsets = shingle_hashes(words, first, g)
        row = np.repeat(np.arange(len(n)), np.diff(offsets))
        place = np.arange(len(gram)) - offsets[row]
        block = place // s
        back = place - (block - 1) * s  # from the boundary one block earlier: the period
        found = np.flatnonzero((block > 0) & (gram == gram[np.arange(len(gram)) - np.minimum(place, back)]))
        order = np.lexsort((place[found] - back[found], back[found], row[found]))
        found = found[order]
        row, q, at = row[found], back[found], place[found] - back[found]
        x = first[row] + at
        m = np.maximum(LEAST - 1, (EXPONENT - 1) * q) - s + 1
        strong = at + q + m <= n[row]
        strong[strong] = same(x[strong], (x + q)[strong], m[strong])
        left, factors = np.where(strong, q, 1), smallest_factors(int(q.max(initial=1)))
        while (left > 1).any():
            factor = factors[left]
            on = np.flatnonzero(left > 1)
            part = q[on] // factor[on]
            strong[on] &= ~same(x[on], x[on] + part, m[on] + q[on] - part)
            left = left // np.maximum(factor, 1)
        follows = np.zeros(len(row) + 1, bool)  # this candidate is the boundary after the one before
        follows[1:-1] = (row[1:] == row[:-1]) & (q[1:] == q[:-1]) & (at[1:] == at[:-1] + s)
        chain = np.cumsum(~follows[:-1]) - 1
        kept = np.bincount(chain, strong, int((~follows[:-1]).sum()))[chain] > 0
        on = np.concatenate([[False], strong, [False]])
        before, after = on[:-2] & follows[:-1], on[2:] & follows[1:]
        opens, closes = np.flatnonzero(strong & ~before & after), np.flatnonzero(strong & before & ~after)
        links = np.stack([row[opens], q[opens], at[opens], at[closes] + q[closes] + m[closes]], axis=1)
        kept &= ~(strong & before & after)
        keys = np.unique(np.stack([row[kept], at[kept]]), axis=1)
        yield s, keys[0], keys[1], links
        s *= 2


def z_function(a: list, upto: int | None = None) -> list:
    """z[i]: how many elements from i on equal those from 0 on, for i below ``upto``; z[0] is the length."""
    n = len(a)
    upto = n if upto is None else min(upto, n)
    z = [0] * max(upto, 1)
    z[0] = n
    lo = hi = 0
    for i in range(1, upto):
        k = z[i - lo] if i < hi else 0
        if i + k >= hi:
            k = max(hi - i, 0)
            while i + k < n and a[k] == a[i + k]:
                k += 1
            lo, hi = i, i + k
        elif k > hi - i:
            k = hi - i
        z[i] = k
    return z


def fragments(codes: np.ndarray, boundary: int, octave: int) -> list[tuple[int, int, int]]:
    """(period, start, end) of the stretches in a tile that repeat across its boundary, for the octave's periods.

    Kept are those that are long enough for a run or cut off by an end of the tile.
    """
    after = codes[boundary:].tolist()
    size, out = len(codes), []
    z = z_function(after, 2 * octave)
    if not any(z[octave:]):
        return out
    # words before the boundary, backwards, against those before boundary + q, backwards
    behind = codes[:boundary][::-1].tolist()
    span = codes[:boundary + 2 * octave][::-1].tolist()
    back = z_function(behind + [-1] + span)
    base = len(behind) + 1 + len(span) - boundary
    for q in range(octave, min(2 * octave, len(after))):
        right, left = z[q], back[base - q] if behind else 0
        start, end = boundary - left, boundary + q + right
        cut = end == size or start == 0 and boundary == octave
        if end - start >= max(LEAST, EXPONENT * q) or cut and right >= GRAM:
            out.append((q, start, end))
    return out


def tiles_of(docs: DataFrame) -> DataFrame:
    """Rows of ``row_keys`` as rows of three kinds: the row itself (octave 0; its text only if it has tiles), its tiles
    (octave s), and its links (octave -q, boundary: the length, no codes).

    A row without tiles has no runs, and its result is settled here.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            data, ends = text_bytes(batch.column("text"))
            starts, stops = word_spans(data, ends, NOT_BLANK)
            words, first = span_hashes(data, starts, stops, np.arange(256, dtype=np.uint8)), row_counts(starts, ends)
            raw, hot, n = data.tobytes(), np.zeros(batch.num_rows, bool), np.diff(first)
            codes = pd.factorize(words)[0].astype("<i4")
            k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
            for s, rows, at, links in hot_tiles(words, first):
                hot[rows] = True
                if len(links):
                    row, q, start, end = links.T
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(len(row), batch.column("doc_id").type), pa.nulls(len(row), pa.string()), pa.array(k1[row]), pa.array(k2[row]),
                         pa.array((-q).astype(np.int32)), pa.array((end - start).astype(np.int32)), pa.array(start.astype(np.int32)),
                         pa.nulls(len(row), pa.binary()), pa.nulls(len(row), pa.string())], NAMES)
                lo, hi = np.maximum(at - s, 0), np.minimum(at + 3 * s + LONG_GRAM, n[rows])
                for a in range(0, len(rows), 4096):
                    part = slice(a, a + 4096)
                    own = [codes[first[r] + x:first[r] + y].tobytes() for r, x, y in zip(rows[part], lo[part], hi[part])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(len(own), batch.column("doc_id").type), pa.nulls(len(own), pa.string()), pa.array(k1[rows[part]]),
                         pa.array(k2[rows[part]]), pa.array(np.full(len(own), s, np.int32)), pa.array((at - lo)[part].astype(np.int32)),
                         pa.array(lo[part].astype(np.int32)), pa.array(own, pa.binary()), pa.nulls(len(own), pa.string())], NAMES)
            plain = [None if h else hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest() for h, a, b in zip(hot, ends, ends[1:])]
            text = [t if h else None for h, t in zip(hot, batch.column("text").to_pylist())]
            none = np.zeros(batch.num_rows, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(text, pa.string()), batch.column("k1"), batch.column("k2"), pa.array(none),
                 pa.array(none), pa.array(none), pa.nulls(batch.num_rows, pa.binary()), pa.array(plain, pa.string())], NAMES)

    return docs.mapInArrow(run, f"doc_id {kind}, text string, {TILES}, plain_sha256 string")


NAMES = ["doc_id", "text", "k1", "k2", "octave", "boundary", "first", "codes", "plain_sha256"]


def solved(tiles: DataFrame) -> DataFrame:
    """Fragments (k1, k2, period, start, end) of tiles and links, which are dealt evenly, whatever document they are of."""
    dealt = tiles.repartition(int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, octave, boundary, first = (batch.column(c).to_numpy() for c in ("k1", "k2", "octave", "boundary", "first"))
            rows = []
            for i, codes in enumerate(batch.column("codes").to_pylist()):
                own = [(-octave[i], 0, boundary[i])] if codes is None else fragments(np.frombuffer(codes, "<i4"), int(boundary[i]), int(octave[i]))
                rows += [(i, q, first[i] + a, first[i] + b) for q, a, b in own]
            got = np.array(rows, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(k1[got[:, 0]]), pa.array(k2[got[:, 0]]), *(pa.array(c) for c in got[:, 1:].T)],
                                             ["k1", "k2", "period", "start", "end"])

    return dealt.select("k1", "k2", "octave", "boundary", "first", "codes").mapInArrow(
        run, "k1 long, k2 long, period long, start long, end long")


def stitched(found: DataFrame) -> DataFrame:
    """Runs (k1, k2, runs: array of start, length, period, sorted by start and period) from fragments.

    Equal fragments (of equal rows) are one before a document's period meets in one place.
    """
    one = found.distinct()
    by_period = W.partitionBy("k1", "k2", "period").orderBy("start", "end")
    reached = F.max("end").over(by_period.rowsBetween(W.unboundedPreceding, -1))
    opens = F.when(F.col("reached") >= F.col("start") + F.col("period"), 0).otherwise(1)
    numbered = one.withColumn("reached", reached).withColumn("island", F.sum(opens).over(by_period))
    whole = numbered.groupBy("k1", "k2", "period", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start")
    whole = whole.where(length >= F.greatest(F.lit(LEAST), EXPONENT * F.col("period")))
    runs = whole.groupBy("k1", "k2", "start", "end").agg(F.min("period").alias("period"))
    return runs.groupBy("k1", "k2").agg(
        F.sort_array(F.collect_list(F.struct("start", (F.col("end") - F.col("start")).alias("length"), "period"))).alias("runs"))


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """Words without those that a run holds after its first period."""
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(drop)) if d == 0]


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_runs, the longest run (start, length, period, exponent_milli), runs, collapsed text's sha256.

    Columns: those of ``RESULT`` and runs, array<struct<start, length, period>>.
    """
    tiled = written(tiles_of(row_keys(docs, doc_id, text)), "tiles")
    kind = docs.schema[doc_id].dataType.simpleString()
    runs = written(stitched(solved(tiled.where("octave <> 0"))), "runs")
    rows = tiled.where("octave = 0")
    busy = rows.where("text IS NOT NULL").select("doc_id", "text", "k1", "k2").join(runs, ["k1", "k2"], "left")
    schema = RESULT.format(kind=kind) + ", runs array<struct<start: long, length: long, period: long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
                own = [(r["start"], r["length"], r["period"]) for r in found or []]
                lines = "".join(f"{a},{n},{q}\n" for a, n, q in own)
                best = max(own, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
                kept = collapsed(text.encode().split(), own)
                digests.append((len(own), *best, 1000 * best[1] // best[2] if own else None, hashlib.sha256(lines.encode()).hexdigest(),
                                hashlib.sha256(b" ".join(kept)).hexdigest()))
            columns = list(zip(*digests)) or [()] * 7
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            runs_of = batch.column("runs").fill_null([]) if batch.num_rows else batch.column("runs")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds)), runs_of],
                ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs"])

    none, empty = F.lit(None).cast("long"), hashlib.sha256(b"").hexdigest()
    quiet = rows.where("text IS NULL").select(
        "doc_id", F.lit(0).cast("long").alias("n_runs"), *(none.alias(c) for c in ("start", "length", "period", "exponent_milli")),
        F.lit(empty).alias("runs_sha256"), F.col("plain_sha256").alias("collapsed_sha256"),
        F.array().cast("array<struct<start: long, length: long, period: long>>").alias("runs"))
    return busy.select("doc_id", "text", "runs").mapInArrow(run, schema).unionByName(quiet)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one document in ten, chosen by the checksum of its id, repeats its words from some place on.

    With h = crc32 of the decimal id and g = h // 10: if h % 10 is 0 and there
    are n > 0 words, word i >= a becomes word a + (i - a) % p, where a = g % n and
    p = 1 + (n - a) // (3 + g % 8). Null ids are never chosen.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def repeat(doc_id, text):
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 or doc_id is None or text is None:
            return text
        words, g = text.encode().split(), h // 10
        if not words:
            return text
        n = len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return b" ".join(words[:a] + [words[a + (i - a) % p] for i in range(a, n)]).decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = [repeat(i, t) for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, one in ten with planted repeats."""
    return periodic_runs(planted(spark.read.parquet(f"{sf_dir}/documents.parquet"))).drop("runs")
