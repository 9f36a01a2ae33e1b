"""Vectorised text helpers for use inside Arrow tasks (numpy over whole batches).

Words, their hashes and shingles are found for a batch of texts at a time,
straight from the UTF-8 buffers of an Arrow column. Hashes are 64-bit and the
same in every process, so they can be shuffled and compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

# Work is cut into pieces of about so many text bytes, to bound a task's memory.
PIECE_BYTES = 1 << 20
BLOCK_BYTES = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

#: Bytes of words split at ASCII blanks: [^\\x20\\x09-\\x0D]+
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[32, 9, 10, 11, 12, 13]] = False

#: Lower-cases A-Z and leaves every other byte.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply, xor-shift), in place on uint64."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r**j and r**-j modulo 2**64 for j below n, kept between calls."""
    global _POW
    if len(_POW[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for base in (_ODD, pow(_ODD, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POW = (out[0], out[1])
    return _POW


_POW: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that a piece has about ``most`` text bytes; a longer text stands alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = text_offsets(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, ends[at] + most, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def text_offsets(texts: pa.Array) -> np.ndarray:
    """Byte offsets (rows + 1) of an Arrow string column; null texts have no bytes."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    return np.concatenate([[0], np.cumsum(lengths)])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column and the offsets of its rows in them."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    raw = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[raw[0]:raw[-1]], (raw - raw[0]).astype(np.int64)


def word_spans(data: np.ndarray, ends: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (byte places) of the words of all rows; no word crosses a row."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    starts = inside[1:] & ~inside[:-1]
    stops = inside[:-1] & ~inside[1:]
    cuts = ends[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]  # a word runs over the end of a row
    starts[cuts] = True
    stops[cuts] = True
    return np.flatnonzero(starts[:-1]), np.flatnonzero(stops)


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, fold: np.ndarray = FOLD) -> np.ndarray:
    """A 64-bit hash of every span's bytes after ``fold``; spans ascend and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(stops, base + BLOCK_BYTES, side="right")))
        part = data[base:stops[to - 1]]
        up, down = powers(len(part) + 1)
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[fold[part]] * up[:len(part)], out=sums[1:])
        a, b = starts[at:to] - base, stops[at:to] - base
        out[at:to] = (sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)
        at = to
    return mix(out)


def row_counts(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Index of the first word of every row, and the total last."""
    return np.searchsorted(starts, ends, side="left")


def word_hashes(texts: pa.Array, is_word: np.ndarray = NOT_BLANK, fold: np.ndarray = FOLD) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, and where each row's words begin (rows + 1)."""
    data, ends = text_bytes(texts)
    starts, stops = word_spans(data, ends, is_word)
    return span_hashes(data, starts, stops, fold), row_counts(starts, ends)


_STEP = [np.uint64(pow(0xC2B2AE3D27D4EB4F, k + 1, 1 << 64)) for k in range(16)]


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles, row after row, with their offsets (rows + 1).

    A row with 1 to k - 1 words has its whole sequence as its one shingle.
    """
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    offsets = np.concatenate([[0], np.cumsum(count)])
    rolled = np.zeros(max(len(words) - k + 1, 0), np.uint64)
    for j in range(k):
        rolled += words[j:j + len(rolled)] * _STEP[j]
    out = np.empty(offsets[-1], np.uint64)
    full = np.flatnonzero(n >= k)
    where = np.repeat(first[full] - offsets[full], count[full]) + ranges(offsets[full], count[full])
    out[ranges(offsets[full], count[full])] = rolled[where]
    for row in np.flatnonzero((n > 0) & (n < k)):
        w = words[first[row]:first[row + 1]]
        salted = (w * np.array(_STEP[:len(w)])).sum(dtype=np.uint64, keepdims=True)
        out[offsets[row]] = (salted + np.uint64(len(w) * _ODD & _MASK))[0]
    return mix(out), offsets


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The integers start[i] ... start[i] + count[i] - 1, one range after the other."""
    total = int(count.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    step = np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    return step + np.arange(total)



class IdTable:
    """Id lists of 64-bit keys: sorted keys, and all lists in one array."""

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.keys, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0

    def missing(self, keys: np.ndarray) -> np.ndarray:
        if len(self.keys) == 0:
            return np.ones(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] != keys

    def add(self, keys: np.ndarray, lists: list[np.ndarray]) -> None:
        flat, counts = np.concatenate(lists), np.array([len(x) for x in lists], np.int64)
        if self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.zeros(max(self.used, len(flat)) + (1 << 16), np.int32)])
        self.ids[self.used:self.used + len(flat)] = flat
        first = self.used + np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.used += len(flat)
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys)
        self.keys, self.first = keys[order], np.concatenate([self.first, first])[order]
        self.count = np.concatenate([self.count, counts])[order]

    def encode(self, hashes: np.ndarray, learn) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all spans in order, and their running number of ids (spans + 1).

        ``learn(places)`` gives the id lists of the spans at some places; it is
        asked for spans not met before. The table is emptied when it would
        outgrow its bound.
        """
        code, keys = pd.factorize(hashes)
        new = self.missing(keys)
        if new.any():
            if len(self.keys) + int(new.sum()) > self.most and len(self.keys):
                self.clear()
                new = np.ones(len(keys), bool)
            first = np.empty(len(keys), np.int64)
            first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
            self.add(keys[new], learn(first[new]))
        at = np.searchsorted(self.keys, keys)
        counts = self.count[at][code]
        ids = self.ids[ranges(self.first[at][code], counts)]
        return ids, np.concatenate([[0], np.cumsum(counts)])
