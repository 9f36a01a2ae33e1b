"""SentencePiece encoding and decoding with a streaming Viterbi search.

A text is segmented into the pieces of a SentencePiece model so that the sum of
their scores is greatest (unigram decoding; ties go to the earlier start).
The search reads characters one by one and holds a window as long as the longest
piece: the scores of its boundaries and the open starts from which a piece
could still reach further. Once every surviving path comes through one
boundary, the ids up to it are final; they are handed out and the steps before
it are dropped. So memory grows only with a stretch over which paths do not
meet, not with the text.

Tasks run the search once per distinct pre-token: a cut in front of a run of
spaces is a boundary that all paths share, as no piece reaches over it.
Characters that are no piece become the ids of their UTF-8 bytes. Decoding is
exact: the text comes back byte by byte, with the model's own space sign, if
a text holds it, as a space.

Defined results: null and empty texts have no ids and decode to the empty
text. Repeated rows get equal results; other columns pass through; an input
column named like a result is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .common import map_rows
from .textkit import IdTable, pieces, span_hashes
from .token_count import SPACE, PieceModel, piece_model, plain_spaces, unit_spans

QUERY = "op5_sentencepiece"
ORACLE = None  # brute-force search, the library and round trips in tests/llm/test_viterbi.py

KEPT = 1_000_000
UNKNOWN_PENALTY = 10.0
_SAME = np.arange(256, dtype=np.uint8)


class StreamingViterbi:
    """Feeds on characters; ``feed`` and ``close`` give the ids that have become final.

    Scores are held for the last boundaries only, as many as the longest piece
    has characters; steps back are held from the last committed boundary.
    """

    def __init__(self, model: PieceModel):
        self.model = model
        self.table, self.unknown, self.longest = _search_table(model)
        self.here = self.begin = 0              # boundaries: the current one, the last committed one
        self.score = [0.0] * (self.longest + 1)  # a ring
        self.back: list[tuple[int, int | str]] = [(0, 0)]  # per boundary from begin on: start of the last step, its id or character
        self.open: list[tuple[int, str]] = []   # starts, ascending, that a longer piece may still use, and what followed them

    def feed(self, text: str) -> list[int]:
        out: list[int] = []
        table, score, ring = self.table, self.score, self.longest + 1
        here, starts, back = self.here, self.open, self.back
        for c in text:
            best, came = None, (here, 0)
            starts.append((here, ""))
            still = []
            for start, read in starts:
                read += c
                found = table.get(read)
                if found is None:
                    continue
                if found[0] is not None:
                    value = score[start % ring] + found[0]
                    if best is None or value > best:
                        best, came = value, (start, found[1])
                if found[2]:
                    still.append((start, read))
            if c not in table or table[c][0] is None:
                value = score[here % ring] + self.unknown
                if best is None or value > best:
                    best, came = value, (here, c)
            here += 1
            score[here % ring] = best
            back.append(came)
            starts = still
            if not starts or len(back) % ring == 0:
                self.here, self.open = here, starts
                out += self._commit()
                back = self.back
        self.here, self.open = here, starts
        return out

    def _commit(self) -> list[int]:
        """Ids up to the last boundary that all surviving paths share."""
        alive = sorted({start for start, _ in self.open} | {self.here})
        while len(alive) > 1:  # step the furthest path back until all have met
            last = self.back[alive.pop() - self.begin][0]
            if last not in alive:
                alive = sorted([*alive, last])
        return self._cut(alive[0])

    def _cut(self, place: int) -> list[int]:
        steps, at = [], place
        while at > self.begin:
            at, step = self.back[at - self.begin]
            steps.append(step)
        self.back = self.back[place - self.begin:]
        self.begin = place
        out: list[int] = []
        for step in reversed(steps):
            if isinstance(step, str):
                out += [self.model.byte[b] for b in step.encode("utf-8", "surrogatepass")]
            else:
                out.append(step)
        return out

    def close(self) -> list[int]:
        return self._cut(self.here)


@lru_cache(maxsize=2)
def _search_table(model: PieceModel) -> tuple[dict[str, tuple[float | None, int, bool]], float, int]:
    """Per piece or prefix: its score (None if no piece), its id, whether a longer piece begins so;
    the score of an unknown character; the length of the longest piece."""
    prefixes = {p[:k] for p in model.piece for k in range(1, len(p))}
    table = {p: (model.score.get(p), model.piece.get(p, 0), p in prefixes) for p in prefixes | set(model.piece)}
    return table, min(model.score.values()) - UNKNOWN_PENALTY, max(map(len, model.piece))


def encode_stream(model: PieceModel, chunks: Iterable[str]) -> Iterator[list[int]]:
    """Ids of a text given in chunks of any size, as they become final; holds no more than the window."""
    search, begun = StreamingViterbi(model), False
    for chunk in chunks:
        if chunk and not begun:
            chunk, begun = " " + chunk, True
        ids = search.feed(chunk.replace(" ", SPACE))
        if ids:
            yield ids
    ids = search.close()
    if ids:
        yield ids


@lru_cache(maxsize=2)
def _table(path: str) -> IdTable:
    return IdTable(KEPT)


def encode(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a column, one after the other, and offsets (rows + 1)."""
    model = piece_model(path)
    data, starts, stops, ends = unit_spans(plain_spaces(pc.fill_null(texts, "")))
    full = np.repeat(np.diff(ends) > 1, np.diff(np.searchsorted(starts, ends)))  # an empty text has only the added space
    starts, stops = starts[full], stops[full]
    raw = data.tobytes()

    def learn(at: np.ndarray) -> list[np.ndarray]:
        out = []
        for i in at:
            search = StreamingViterbi(model)
            unit = raw[starts[i]:stops[i]].decode("utf-8", "surrogatepass").replace(" ", SPACE)
            out.append(np.array(search.feed(unit) + search.close(), np.int32))
        return out

    if len(starts) == 0:
        return np.zeros(0, np.int32), np.zeros(len(ends), np.int64)
    ids, sums = _table(path).encode(span_hashes(data, starts, stops, _SAME), learn)
    return ids, sums[np.searchsorted(starts, ends, side="left")]


@lru_cache(maxsize=2)
def piece_bytes(model: PieceModel) -> list[bytes]:
    """UTF-8 bytes that every id stands for."""
    out = [b""] * model.size
    for p, i in model.piece.items():
        out[i] = p.replace(SPACE, " ").encode()
    for b, i in model.byte.items():
        out[i] = bytes([b])
    return out


def decode(model: PieceModel, ids: Iterable[int]) -> bytes:
    """The text of some ids, as UTF-8."""
    return b"".join(map(piece_bytes(model).__getitem__, ids))[1:]


def sentencepiece_encode(docs: DataFrame, path: str, text: str = "text", with_ids: bool = True) -> DataFrame:
    """``docs`` with n_ids, ids_crc32 (of the ids as little-endian unsigned 32-bit integers), round_trip and ids."""
    def on(column: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = piece_model(path)
            for batch in pieces(batches, column):
                ids, at = encode(path, batch.column(column))
                parts = [ids[a:b] for a, b in zip(at, at[1:])]
                same = [decode(model, x.tolist()) == t.encode("utf-8", "surrogatepass") for x, t in zip(
                    parts, plain_spaces(pc.fill_null(batch.column(column), "")).to_pylist())]
                columns = [pa.array(np.diff(at)), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in parts], pa.int64()),
                           pa.array(same, pa.bool_())]
                if with_ids:
                    columns.append(pa.array(parts, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *columns],
                    [*batch.schema.names, "n_ids", "ids_crc32", "round_trip", "ids"][:batch.num_columns + len(columns)])
        return run

    return map_rows(docs, text, "n_ids long, ids_crc32 long, round_trip boolean" + ", ids array<int>" * with_ids, on)


def sentencepiece_decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with decoded, the text of its id lists; a null list decodes to null."""
    def on(column: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [None if x is None else decode(piece_model(path), x).decode("utf-8", "replace")
                         for x in batch.column(column).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])
        return run

    return map_rows(encoded, ids, "decoded string", on)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return sentencepiece_encode(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=False).drop("text")
