"""Token counts of a SentencePiece BPE model by rank-synchronous array merging.

A text is cut into pre-tokens in front of every run of spaces; no piece of the
model reaches over such a cut (checked when the model is read), so merges on
either side do not influence each other. The distinct pre-tokens of a batch
are held as one ragged numpy array of symbol ids. In every round each
pre-token merges its lowest-rank pair (the leftmost, if it occurs again), all
pre-tokens at once; after the last round the surviving symbols are counted.
Characters that are no piece count as their UTF-8 bytes (byte fallback).

Counts of pre-tokens seen before are kept, up to ``KEPT`` per Python worker.
Pre-tokens longer than ``LONG`` symbols are merged one by one from a heap with
the same rule, as rounds over them would be many.

Defined results: a null or empty text has 0 bytes and 0 tokens. Repeated rows
get equal results; other columns pass through; an input column named like a
result is replaced.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from .common import map_rows
from .textkit import pieces, span_hashes, text_bytes

QUERY = "op7_token_count"
ORACLE = None  # the library's own counts in tests/llm/test_token_count.py

LIMIT = 4096
KEPT = 2_000_000
LONG = 256
_SAME = np.arange(256, dtype=np.uint8)
_NONE = np.iinfo(np.int64).max
SPACE = "▁"


class PieceModel:
    """Pieces of a SentencePiece BPE model and the pairs that merge to a piece."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(model.get_piece_size())
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        piece = {model.id_to_piece(i): i for i in normal}
        if any(SPACE in p.lstrip(SPACE) for p in piece):
            raise ValueError("a piece reaches over the start of a run of spaces")
        self.size = model.get_piece_size()
        self.piece = piece
        self.score = {p: model.get_score(i) for p, i in piece.items()}
        self.byte = {b: model.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        ranks = {s: r for r, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        pairs = [(piece[p[:k]] * self.size + piece[p[k:]], i, ranks[self.score[p]])
                 for p, i in piece.items() for k in range(1, len(p)) if p[:k] in piece and p[k:] in piece]
        pairs.sort()
        self.keys = np.array([p[0] for p in pairs], np.int64)
        self.merged = np.array([p[1] for p in pairs], np.int64)
        self.ranks = np.array([p[2] for p in pairs], np.int64)
        self.char = np.full(0x110000, -1, np.int64)
        for p, i in piece.items():
            if len(p) == 1:
                self.char[ord(p)] = i

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each adjacent pair; rank _NONE where nothing merges."""
        key = np.where((left < 0) | (right < 0), -1, left * self.size + right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _NONE), np.where(hit, self.merged[at], -1)


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def symbols(model: PieceModel, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbol ids of all units, one after the other, and offsets; a character that is no piece is -(its bytes)."""
    codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ids = model.char[codes]
    width = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
    return np.where(ids >= 0, ids, -width), np.concatenate([[0], np.cumsum([len(u) for u in units])]).astype(np.int64)


def merge_rounds(model: PieceModel, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tokens of every sequence after all rounds."""
    n = len(offsets) - 1
    total = np.zeros(n, np.int64)
    seq = np.repeat(np.arange(n), np.diff(offsets))
    last = np.ones(len(ids), bool)
    last[:-1] = seq[1:] != seq[:-1]
    right = np.append(ids[1:], -1)
    rank, into = model.pair(ids, np.where(last, -1, right))
    while len(ids):
        first = np.flatnonzero(np.concatenate([[True], seq[1:] != seq[:-1]]))
        lowest = np.minimum.reduceat(rank, first)
        done = lowest == _NONE
        if done.any():  # nothing left to merge in these: their symbols are counted
            per = np.repeat(done, np.diff(np.append(first, len(ids))))
            total += np.bincount(seq[per], np.where(ids[per] < 0, -ids[per], 1), n).astype(np.int64)
            ids, seq, rank, into = ids[~per], seq[~per], rank[~per], into[~per]
            if len(ids) == 0:
                break
            first = np.flatnonzero(np.concatenate([[True], seq[1:] != seq[:-1]]))
            lowest = lowest[~done]
        size = np.diff(np.append(first, len(ids)))
        hit = np.flatnonzero(rank == np.repeat(lowest, size))
        at = hit[np.concatenate([[True], seq[hit[1:]] != seq[hit[:-1]]])]  # the leftmost of each sequence
        ids[at] = into[at]
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        place = np.cumsum(keep) - 1
        ids, seq, rank, into = ids[keep], seq[keep], rank[keep], into[keep]
        here = place[at]
        for left in (here, here[(here > 0) & (seq[np.maximum(here - 1, 0)] == seq[here])] - 1):
            after = np.minimum(left + 1, len(ids) - 1)
            inside = (left + 1 < len(ids)) & (seq[after] == seq[left])
            rank[left], into[left] = model.pair(ids[left], np.where(inside, ids[after], -1))
    return total


def merge_heap(model: PieceModel, ids: np.ndarray) -> int:
    """Tokens of one long sequence: the lowest-rank, leftmost pair first, from a heap."""
    rank, into = model.pair(ids, np.append(ids[1:], -1))
    heap = [(int(r), i, int(ids[i]), int(ids[i + 1]), int(m)) for i, (r, m) in enumerate(zip(rank, into)) if r != _NONE]
    heapq.heapify(heap)
    ids, after, before = ids.tolist(), list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    alive = [True] * len(ids)
    table = _pair_table(model)

    def push(i: int, j: int) -> None:
        found = table.get((ids[i], ids[j]))
        if found:
            heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))

    while heap:
        _, i, a, b, m = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= len(ids) or ids[i] != a or ids[j] != b:
            continue
        ids[i], alive[j], after[i] = m, False, after[j]
        if after[i] < len(ids):
            before[after[i]] = i
            push(i, after[i])
        if before[i] >= 0:
            push(before[i], i)
    return sum(-x if x < 0 else 1 for x, ok in zip(ids, alive) if ok)


@lru_cache(maxsize=2)
def _pair_table(model: PieceModel) -> dict[tuple[int, int], tuple[int, int]]:
    return {(k // model.size, k % model.size): (r, m)
            for k, r, m in zip(model.keys.tolist(), model.ranks.tolist(), model.merged.tolist())}


def count_units(model: PieceModel, units: list[str]) -> np.ndarray:
    """Tokens of every pre-token."""
    out = np.zeros(len(units), np.int64)
    short = [i for i, u in enumerate(units) if len(u) <= LONG]
    if short:
        ids, at = symbols(model, [units[i] for i in short])
        out[short] = merge_rounds(model, ids, at)
    for i, u in enumerate(units):
        if len(u) > LONG:
            out[i] = merge_heap(model, symbols(model, [u])[0])
    return out


def unit_spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, each behind one added space, the start and end of their pre-tokens, and text starts."""
    data, ends = text_bytes(texts)
    data = np.insert(data, ends[:-1], 32)
    ends = ends + np.arange(len(ends))
    space = data == 32
    start = space.copy()
    start[1:] &= ~space[:-1]
    start[ends[:-1]] = True
    starts = np.flatnonzero(start)
    return data, starts, np.append(starts[1:], len(data)), ends


class Kept:
    """Values of 64-bit keys, as sorted arrays; emptied when it would grow past ``most``."""

    def __init__(self, most: int):
        self.most, self.keys, self.values = most, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.keys) == 0:
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, self.values[at]

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        if len(self.keys) + len(keys) > self.most:
            self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, values = np.concatenate([self.keys, keys]), np.concatenate([self.values, values])
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]


@lru_cache(maxsize=2)
def _kept(path: str) -> Kept:
    return Kept(KEPT)


def plain_spaces(texts: pa.Array) -> pa.Array:
    """The model's own space sign in a text is a space to it."""
    return pc.replace_substring(texts, SPACE, " ")


def count_tokens(path: str, texts: pa.Array) -> np.ndarray:
    """Tokens of every text of a column."""
    model, kept = piece_model(path), _kept(path)
    data, starts, stops, ends = unit_spans(plain_spaces(texts))
    codes, keys = pd.factorize(span_hashes(data, starts, stops, _SAME))
    known, value = kept.find(keys)
    new = np.flatnonzero(~known)
    if len(new):
        at = np.full(len(keys), -1)
        at[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)  # the first place of every key
        raw = data.tobytes()
        units = [raw[starts[i]:stops[i]].decode("utf-8", "surrogatepass").replace(" ", SPACE) for i in at[new]]
        value[new] = count_units(model, units)
        kept.add(keys[new], value[new])
    rows = np.searchsorted(ends, starts, side="right") - 1
    counts = np.bincount(rows, value[codes], len(texts)).astype(np.int64)
    return np.where(np.diff(ends) == 1, 0, counts)


def token_count(docs: DataFrame, path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes, n_tokens (long) and over_limit (boolean)."""
    def on(column: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, column):
                texts = pc.fill_null(batch.column(column), "")
                n = count_tokens(path, texts)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pc.binary_length(texts).cast(pa.int64()), pa.array(n), pa.array(n > limit)],
                    [*batch.schema.names, "n_bytes", "n_tokens", "over_limit"])
        return run

    return map_rows(docs, text, "n_bytes long, n_tokens long, over_limit boolean", on)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_count(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")
