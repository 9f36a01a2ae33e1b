"""Substring dedup by De Bruijn compaction.

The edges of the graph are the corpus' k-mers of ``WINDOW`` words; an edge that
occurs twice marks all its words. Shuffling an edge per word would move a
multiple of the corpus, so edges travel as paths. Each edge has an anchor, the
least hash among the ``GRAM``-word grams in it; consecutive edges of a document
with one anchor are a piece, about 15 edges in a row, which is one row.

1. Pieces are counted (combined on the map side first: a passage that a third
   of all documents share is one row per task). A piece that occurs twice
   repeats whole. A piece that occurs once may still hold repeated edges, but
   only if other pieces have its anchor, since equal edges have equal anchors.
2. Repeated pieces are compacted. One leads on to another without branching if
   every occurrence of the first is followed by the second and every
   occurrence of the second preceded by the first. Then their first
   occurrences in the corpus (by coordinate) lie side by side too, so one join on
   coordinates finds all such links, and the pieces between two branches
   become one path: a long repeated span with its number of copies.
3. At the source coordinates of each path a digest of its words is taken;
   of pieces that share an anchor with others, every distinct one, whatever
   its number of copies, gives its edges there too, and edges are counted.
4. Every document gets the spans of its paths, each with the digest, and of its
   other pieces the repeated edges. A span is taken out only if its own words have the
   same digest: 128 bits, next to the 64 by which pieces and edges are compared.

Defined results: a null or blank text has no words; one of fewer than ``WINDOW``
words has no edge and stays whole. Windows are judged on the input. Rows of
equal id and text are different documents and so lose all their edges; null
ids are ids like others. An empty table gives no rows. Columns other than
id and text are not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, row_keys, written
from .textkit import NOT_BLANK, pieces as text_pieces, powers, mix, ranges, row_counts, shingle_hashes, span_hashes, text_bytes, word_spans

QUERY = "op12_substring_dedup"

WINDOW = 35  # words of an edge
GRAM = 8     # words of a gram; the least gram hash of an edge is its anchor

#: Every 35 words in a row as one string; words under a window that is there twice go.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT rid, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s FROM d, unnest(range(1, len(w) - {WINDOW - 2})) t(i)),
rep AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, i + j AS place FROM win JOIN rep USING (s), unnest(range(0, {WINDOW})) u(j)),
word AS (SELECT rid, place, w[place] AS v FROM d, unnest(range(1, len(w) + 1)) t(place)),
kept AS (SELECT rid, string_agg(v, ' ' ORDER BY place) AS k, count(*) AS n FROM word ANTI JOIN gone USING (rid, place) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

_EVERY = np.arange(256, dtype=np.uint8)


class Words:
    """Hashes of the words of a batch of texts, and of any of their stretches."""

    def __init__(self, texts: pa.Array):
        data, ends = text_bytes(texts)
        starts, stops = word_spans(data, ends, NOT_BLANK)
        self.hashes, self.first = span_hashes(data, starts, stops, _EVERY), row_counts(starts, ends)
        self.up, self.down = powers(len(self.hashes) + 1)
        self.sums = np.zeros(len(self.hashes) + 1, np.uint64)
        np.cumsum(self.hashes * self.up[:len(self.hashes)], out=self.sums[1:])

    def stretch(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """64-bit hashes of the ``size`` words from places ``at`` on."""
        return mix((self.sums[at + size] - self.sums[at]) * self.down[at] + np.uint64(1) * np.asarray(size).astype(np.uint64))


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def graph_pieces(words: Words) -> tuple[np.ndarray, ...]:
    """Pieces of all rows: row, first edge (a word number in the row), edges, anchor, hash, and the hashes before and after."""
    first, n = words.first, np.diff(words.first)
    edges = np.maximum(n - WINDOW + 1, 0)
    if not edges.any():
        return tuple(np.zeros(0, np.int64) for _ in range(7))
    grams = mix(sum(words.hashes[j:len(words.hashes) - GRAM + 1 + j] * np.uint64(pow(0xC2B2AE3D27D4EB4F, j + 1, 1 << 64)) for j in range(GRAM)))
    # the low bits tell equal grams of one window apart by place; which of them is taken changes pieces, not anchors
    low = np.uint64(0xFFFF)
    tagged = grams & ~low | np.arange(len(grams), dtype=np.uint64) & low
    row = np.repeat(np.arange(len(n)), edges)
    at = ranges(first[:-1], edges)
    anchor = least(tagged, WINDOW - GRAM + 1)[at]
    opens = np.ones(len(at), bool)
    opens[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(opens)
    count = np.diff(np.append(begin, len(at)))
    row, at, anchor = row[begin], at[begin], anchor[begin] >> np.uint64(16)
    own = words.stretch(at, count + WINDOW - 1).view(np.int64)
    before, after = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
    beside = row[1:] == row[:-1]
    before[1:][beside], after[:-1][beside] = own[:-1][beside], own[1:][beside]
    return row, at - first[row], count, anchor.view(np.int64), own, before, after


def piece_table(docs: DataFrame) -> DataFrame:
    """Rows of ``row_keys`` as pieces: k1, k2, at, edges, anchor, piece, before, after (0: no piece there)."""
    names = ["k1", "k2", "at", "edges", "anchor", "piece", "before", "after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_pieces(batches, "text"):
            row, at, edges, *rest = graph_pieces(Words(batch.column("text")))
            k1, k2 = (batch.column(c).to_numpy()[row] for c in ("k1", "k2"))
            yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), pa.array(at.astype(np.int32)), pa.array(edges.astype(np.int32)),
                                              *(pa.array(c) for c in rest)], names)

    return docs.select("k1", "k2", "text").mapInArrow(
        run, "k1 long, k2 long, at int, edges int, anchor long, piece long, before long, after long")


def distinct_pieces(found: DataFrame) -> DataFrame:
    """One row per distinct piece: copies, its only neighbours (null if they differ), first occurrence k1, k2, at, edges."""
    only = lambda c: F.when((F.min(c) == F.max(c)) & (F.min(c) != 0), F.min(c))
    return found.groupBy("anchor", "piece").agg(
        F.count(F.lit(1)).alias("copies"), only("before").alias("before"), only("after").alias("after"),
        F.min(F.struct("k1", "k2", "at", "edges")).alias("source")).select(
        "anchor", "piece", "copies", "before", "after", "source.*")


def compacted(repeated: DataFrame) -> DataFrame:
    """Nonbranching paths of repeated pieces: head (its first piece), copies, source k1, k2, at, and edges of all its pieces."""
    ahead = repeated.select("k1", "k2", "at", F.col("piece").alias("next"), F.col("before").alias("next_before"))
    behind = repeated.select("k1", "k2", (F.col("at") + F.col("edges")).alias("at"), "piece", "after")
    linked = behind.join(ahead, ["k1", "k2", "at"]).where((F.col("after") == F.col("next")) & (F.col("next_before") == F.col("piece")))
    inner = linked.select(F.col("next").alias("piece"), F.lit(True).alias("inner"))
    marked = repeated.join(inner, "piece", "left")
    along = W.partitionBy("k1", "k2").orderBy("at")
    numbered = marked.withColumn("path", F.sum(F.when(F.col("inner"), 0).otherwise(1)).over(along))
    return numbered.groupBy("k1", "k2", "path").agg(
        F.min_by("piece", "at").alias("head"), F.min("at").alias("at"), F.sum("edges").alias("edges"), F.max("copies").alias("copies"),
    ).drop("path")


def digest(words: list) -> tuple[int, int]:
    """128 bits of words joined by spaces, as two signed numbers."""
    d = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def read_sources(docs: DataFrame, paths: DataFrame, shared: DataFrame) -> DataFrame:
    """Digests of paths (head, d1, d2) and edges of shared pieces (piece, place, edge, copies) from their source documents."""
    wanted = paths.select("k1", "k2", F.lit(0).alias("kind"), "at", "edges", F.col("head").alias("name"), "copies").unionByName(
        shared.select("k1", "k2", F.lit(1).alias("kind"), "at", "edges", F.col("piece").alias("name"), "copies"))
    wanted = written(wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("kind", "at", "edges", "name", "copies")).alias("wanted")), "wanted")
    sources = docs.select("k1", "k2", "text").join(wanted, ["k1", "k2"]).select("text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_pieces(batches, "text"):
            words = Words(batch.column("text"))
            asked = batch.column("wanted")
            row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(asked.offsets)))
            kind, at, edges, name, copies = (c.to_numpy() for c in asked.flatten().flatten())
            texts, split = batch.column("text").to_pylist(), {}
            d = []
            for i in np.flatnonzero(kind == 0):
                own = split.setdefault(row[i], texts[row[i]].encode().split()) if row[i] not in split else split[row[i]]
                d.append(digest(own[at[i]:at[i] + edges[i] + WINDOW - 1]))
            d = np.array(d, np.int64).reshape(-1, 2)
            zero = np.zeros(len(d), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (zero.astype(np.int32), name[kind == 0], zero, d[:, 0], d[:, 1])], NAMES)
            on = np.flatnonzero(kind == 1)
            each = np.repeat(on, edges[on])
            place = ranges(np.zeros(len(on), np.int64), edges[on].astype(np.int64))
            edge = words.stretch(words.first[row[each]] + at[each] + place, WINDOW).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(each), np.int32)), pa.array(name[each]), pa.array(place), pa.array(edge),
                                              pa.array(copies[each].astype(np.int64))], NAMES)

    return sources.mapInArrow(run, "kind int, name long, place long, a long, b long")


NAMES = ["kind", "name", "place", "a", "b"]


def repeated_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Repeated spans per row key, written (k1, k2, spans: array of at, edges, d1, d2; digests null where single edges were counted).

    ``docs``: rows of ``row_keys``; ``found``: their ``piece_table``, written.
    """
    graph = written(distinct_pieces(found), "graph")
    paths = written(compacted(graph.where("copies > 1")), "paths")
    # small sides are written first, so that a join's large side alone decides how a hot key is split
    crowded = written(graph.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "anchors")
    seen = written(read_sources(docs, paths, graph.join(crowded, "anchor")), "sources")
    digests = seen.where("kind = 0").select(F.col("name").alias("head"), F.col("a").alias("d1"), F.col("b").alias("d2")).distinct()
    known = written(paths.select("head", "edges").join(digests, "head"), "known")
    edges = seen.where("kind = 1").select("name", "place", F.col("a").alias("edge"), F.col("b").alias("copies")).distinct()
    twice = written(edges.groupBy("edge").agg(F.sum("copies").alias("total")).where("total > 1").select("edge"), "twice")
    single = edges.where("copies = 1").join(twice, "edge").groupBy(F.col("name").alias("piece")).agg(F.collect_set("place").alias("places"))
    single = written(single, "single")
    whole = found.select("k1", "k2", "at", F.col("piece").alias("head")).join(known, "head").select(
        "k1", "k2", F.struct("at", "edges", "d1", "d2").alias("span"))
    none = F.lit(None).cast("long")
    parts = found.select("k1", "k2", "at", "piece").join(single, "piece").select("k1", "k2", "at", F.explode("places").alias("place")).select(
        "k1", "k2", F.struct((F.col("at") + F.col("place")).cast("int").alias("at"), F.lit(1).cast("long").alias("edges"),
                             none.alias("d1"), none.alias("d2")).alias("span"))
    one = whole.unionByName(parts).distinct()  # rows of equal id and text have equal spans
    spans = written(one.groupBy("k1", "k2").agg(F.collect_list("span").alias("spans")), "spans")
    discard(graph, paths, crowded, seen, known, twice, single)
    return spans


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, removed (array of first word and end), and with_text the kept words as text."""
    rows = row_keys(docs, doc_id, text)
    found = written(piece_table(rows), "pieces")
    spans = repeated_spans(rows, found)
    discard(found)
    kind = rows.schema["doc_id"].dataType.simpleString()
    joined = rows.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = (text or "").encode().split()
                edge = np.zeros(len(words) + 2, np.int64)
                for s in own or []:
                    at, end = s["at"], s["at"] + s["edges"] + WINDOW - 1
                    if s["d1"] is None or digest(words[at:end]) == (s["d1"], s["d2"]):
                        edge[at + 1] += 1
                        edge[end + 1] -= 1
                gone = np.cumsum(edge) > 0  # one place more at either end
                cuts = np.flatnonzero(gone[1:] != gone[:-1]).reshape(-1, 2)
                kept = b" ".join(w for w, g in zip(words, gone[1:]) if not g) if len(cuts) else b" ".join(words)
                out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), [{"start": int(a), "end": int(b)} for a, b in cuts],
                            kept.decode() if with_text else None))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], RESULT)

    done = joined.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, "
                                  "removed array<struct<start: long, end: long>>, kept string")
    return done if with_text else done.drop("kept")


RESULT = ["doc_id", "n_words", "n_removed", "kept_sha256", "removed", "kept"]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of 35 words taken out of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return substring_dedup(docs).drop("removed")
