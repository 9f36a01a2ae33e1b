"""Token ids of a byte-level BPE tokenizer file, for whole Arrow columns.

The tokenizers library encodes every distinct pre-token once; equal pre-tokens
of a worker take their ids from a table. The cuts between pre-tokens are found
with numpy for all texts of a batch together. A text goes to the library as a
whole if it holds a character outside the table of classes below or the string
of an added token.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from .textkit import BLOCK_BYTES, IdTable, mix, powers

KEPT = 600_000  # distinct pre-tokens kept per worker
CHUNK = 4096      # pre-tokens that the library encodes in one text

_LETTER, _DIGIT, _SPACE, _OTHER, _OUTSIDE = range(5)
_TOP = 0x250


def _class_table() -> np.ndarray:
    """Class of every code point; those from _TOP on are left to the library, but for common punctuation."""
    table = np.full(0x110000, _OUTSIDE, np.uint8)
    for c in range(_TOP):
        kind = unicodedata.category(chr(c))[0]
        table[c] = _LETTER if kind == "L" else _DIGIT if kind == "N" else _OTHER
    table[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = _SPACE
    table[0x2010:0x2028] = _OTHER
    table[0x2030:0x205F] = _OTHER
    return table


_CLASS = _class_table()


def cuts(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens of all texts, by the rules of the byte-level pattern.

    That is: a contraction ('s 't 're 've 'm 'll 'd), or a run of letters,
    digits or other signs with at most one blank in front, or white space,
    whose last sign is left over if something follows it.
    """
    n = len(codes)
    kind = _CLASS[codes]
    head = np.zeros(n + 1, bool)
    head[ends[:-1]] = True
    head[n] = True
    before = np.empty(n, np.uint8)
    before[1:] = kind[:-1]
    before[head[:-1]] = 255  # nothing stands before a text
    blank_before = np.zeros(n, bool)
    blank_before[1:] = codes[:-1] == 32
    blank_before &= ~head[:-1]
    start = (kind != before) & ~blank_before
    start |= (kind == _SPACE) & (before != _SPACE)
    after_solid = np.zeros(n, bool)
    after_solid[:-1] = (kind[1:] != _SPACE)
    after_solid &= ~head[1:]
    start |= (kind == _SPACE) & after_solid
    marks = np.flatnonzero((codes == 39) & (before != _OTHER) & ~blank_before)
    if len(marks):
        room = np.searchsorted(ends, marks, side="right")
        left = ends[room] - marks
        one = np.where(left > 1, codes[np.minimum(marks + 1, n - 1)], 0)
        two = np.where(left > 2, codes[np.minimum(marks + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(marks), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        size = np.where(short, 2, np.where(long, 3, 0))
        marks, size = marks[size > 0], size[size > 0]
        start[marks + 1] = False
        stop = marks + size
        stop = stop[stop < n]
        goes_on = ~((kind[stop] == _SPACE) & ~start[stop])
        start[stop[goes_on]] = True
    start[ends[:-1][ends[:-1] < n]] = True
    return np.flatnonzero(start)


class ByteBpe:
    """The tokenizer of a file, with a table of the pre-tokens met so far."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.added = [t["content"] for t in json.load(open(path))["added_tokens"]]
        self.table = IdTable(KEPT)

    def _learn(self, words: list[str]) -> list[np.ndarray]:
        """Ids of pre-tokens: many in one text, each on a line of its own, taken apart by word number."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        plain = [i for i, w in enumerate(words) if not w.isspace() and "\n" not in w]
        alone = list(set(range(len(words))) - set(plain))
        for s in range(0, len(plain), CHUNK):
            part = plain[s:s + CHUNK]
            got = self.library.encode("\n".join(words[i] for i in part) + "\n", add_special_tokens=False)
            number = np.array(got.word_ids, np.int64)
            if number[-1] != 2 * len(part) - 1:  # a word was cut further
                alone += part
                continue
            tokens, edges = np.array(got.ids, np.int32), np.searchsorted(number, np.arange(0, 2 * len(part) + 1))
            for k, i in enumerate(part):
                out[i] = tokens[edges[2 * k]:edges[2 * k + 1]]
        for i in alone:
            out[i] = np.array(self.library.encode(words[i], add_special_tokens=False).ids, np.int32)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and offsets (rows + 1); null texts have none."""
        texts = pc.fill_null(texts, "").to_pylist()
        whole = "".join(texts)
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        odd = np.zeros(len(texts), bool)
        outside = np.flatnonzero(_CLASS[codes] == _OUTSIDE)
        odd[np.searchsorted(ends, outside, side="right") - 1] = True
        for token in self.added:
            if token in whole:
                odd |= np.array([token in t for t in texts])
        if odd.any():
            return self._mixed(texts, odd)
        return self._by_table(whole, codes, ends)

    def _mixed(self, texts: list[str], odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        plain, at = self.encode(pa.array([t for t, o in zip(texts, odd) if not o], pa.string()))
        rest = iter([plain[a:b] for a, b in zip(at, at[1:])])
        parts = [np.array(self.library.encode(t, add_special_tokens=False).ids, np.int32) if o else next(rest)
                 for t, o in zip(texts, odd)]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return np.concatenate(parts) if parts else np.zeros(0, np.int32), offsets

    def _by_table(self, whole: str, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(codes) == 0:
            return np.zeros(0, np.int32), np.zeros(len(ends), np.int64)
        starts = cuts(codes, ends)
        stops = np.append(starts[1:], len(codes))
        ids, sums = self.table.encode(
            _code_hashes(codes, starts, stops), lambda at: self._learn([whole[starts[i]:stops[i]] for i in at]))
        return ids, sums[np.searchsorted(starts, ends, side="left")]


def _code_hashes(codes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of code points, in blocks of bounded size."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(stops, base + BLOCK_BYTES, side="right")))
        part = codes[base:stops[to - 1]].astype(np.uint64) + np.uint64(1)
        part *= np.uint64(0xA0761D6478BD642F)
        part ^= part >> np.uint64(29)
        up, down = powers(len(part) + 1)
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(part * up[:len(part)], out=sums[1:])
        a, b = starts[at:to] - base, stops[at:to] - base
        out[at:to] = (sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)
        at = to
    return mix(out)


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """The tokenizer of a file, once per process."""
    return ByteBpe(path)
