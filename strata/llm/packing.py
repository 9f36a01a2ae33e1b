"""Best-fit packing by minimum bin slack.

Documents are encoded, closed with the end id and cut into pieces of at most
``capacity`` ids (only longer documents are cut; the first piece may be
shorter). Pieces are then packed by length: per sequence, a bitset subset-sum
over the lengths still available finds the fullest combination that holds the
longest one; it is removed, as many times as the counts allow.

Only the histogram of lengths (at most ``capacity`` counts, whatever the
corpus) is on the driver. It yields a plan of as many rows, "the pieces
numbered i to j of length n go, u to a sequence, to sequences from s at offset
o", which every task applies to its own pieces. Pieces are numbered within
their length without gathering a length anywhere: per length and hash slot
they are counted, slots are summed up, and only a slot's pieces are sorted, so a
length that a third of all pieces share is spread over the slots.

Defined results: a null or empty text is the end id alone. Repeated rows are
packed as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .byte_bpe import byte_bpe
from .common import extended, quoted, written
from .textkit import pieces as text_pieces

QUERY = "op8_packing"
ORACLE = None  # rules of a valid packing and a brute-force optimum in tests/llm/test_packing.py

END_ID = 2
CAPACITY = 1024
SLOT_ROWS = 500_000  # pieces of one length that a slot is meant to hold
LEAST_SLOTS = 64


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity
    edges = ([0] if first else []) + list(range(first, length + 1, capacity))
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text",
                 with_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32, and ids if asked for."""
    keyed = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).alias("text"))
    kind = keyed.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_pieces(batches, "text"):
            ids, at = byte_bpe(path).encode(batch.column("text"))
            rows = []
            for row, (a, b) in enumerate(zip(at, at[1:])):
                own = np.append(ids[a:b], END_ID).astype("<u4")
                rows += [(row, k, start, own[start:start + n]) for k, (start, n) in enumerate(cut(len(own), capacity))]
            columns = [batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64())),
                       pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64()),
                       pa.array([len(r[3]) for r in rows], pa.int64()),
                       pa.array([zlib.crc32(r[3].tobytes()) for r in rows], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array([r[3].astype(np.int64) for r in rows], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return keyed.mapInArrow(run, schema + (", ids array<long>" if with_ids else ""))


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest combination with the longest available length: length -> how many.

    Bit s of ``reach`` says that some combination sums to s. Lengths join in
    descending order, so that short ones stay for closing later gaps; the
    walk back over the saved bitsets takes as few of the last ones as it can.
    """
    lengths = sorted((n for n, c in counts.items() if c > 0), reverse=True)
    top = lengths[0]
    limit = capacity - top
    full, steps = (1 << (limit + 1)) - 1, []
    reach, best = 1, 0
    for n in lengths:
        for _ in range(min(counts[n] - (n == top), limit // n)):
            grown = (reach | reach << n) & full
            if grown == reach:
                break
            steps.append((n, reach))
            reach = grown
        best = reach.bit_length() - 1
        if best == limit:
            break
    out = {top: 1}
    for n, before in reversed(steps):
        if not before >> best & 1:
            out[n] = out.get(n, 0) + 1
            best -= n
    return out


def packing_plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Rows (length, first number, end, per sequence, first sequence, offset) and the number of sequences."""
    left, used, plan, sequences = dict(counts), dict.fromkeys(counts, 0), [], 0
    while any(left.values()):
        chosen = fullest(left, capacity)
        times = min(left[n] // k for n, k in chosen.items())
        offset = 0
        for n, k in sorted(chosen.items(), reverse=True):
            plan.append((n, used[n], used[n] + k * times, k, sequences, offset))
            used[n] += k * times
            left[n] -= k * times
            offset += n * k
        sequences += times
        left = {n: c for n, c in left.items() if c}
    return plan, sequences


def numbered(pieces: DataFrame, n_pieces: int) -> DataFrame:
    """``pieces`` with number: 0, 1, ... within each length, no length gathered in one place."""
    slots = max(LEAST_SLOTS, -(-n_pieces // SLOT_ROWS))
    slotted = pieces.withColumn("slot", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slots)).cast("int"))
    per_slot = slotted.groupBy("length", "slot").agg(F.count("*").alias("c"))
    before = W.partitionBy("length").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    firsts = per_slot.select(F.col("length").alias("of_length"), F.col("slot").alias("of_slot"),
                             F.coalesce(F.sum("c").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(W.partitionBy("length", "slot").orderBy("doc_id", "piece")) - 1
    return slotted.withColumn("place", place).join(
        firsts, (F.col("length") == F.col("of_length")) & (F.col("slot") == F.col("of_slot"))).withColumn(
        "number", F.col("first") + F.col("place")).drop("slot", "place", "of_length", "of_slot", "first")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset."""
    pieces = written(pieces, "pieces")
    counts = {r["length"]: r["c"] for r in pieces.groupBy("length").agg(F.count("*").alias("c")).collect()}  # <= capacity rows
    plan, _ = packing_plan(counts, capacity)
    table = np.array(sorted(plan), np.int64).reshape(-1, 6)
    rows = numbered(pieces, sum(counts.values()))
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = int(table[:, 2].max()) + 1 if len(table) else 1
        starts = table[:, 0] * wide + table[:, 1]
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            row = table[np.searchsorted(starts, length * wide + number, side="right") - 1]
            at = number - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(row[:, 4] + at // row[:, 3]), pa.array(row[:, 5] + at % row[:, 3] * length)],
                [*names, "sequence_id", "offset"])

    return rows.mapInArrow(run, extended(rows, "sequence_id long, offset long")).drop("number")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the packed pieces of every document."""
    return pack(token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))
