"""Token-ID files: independent zstandard frames, a document index and a trailing seek table.

Layout of a file::

    frame 0, frame 1, ...     zstandard frames with content checksums; together they hold the ids of the
                              file's documents as little-endian unsigned 32-bit integers
    document index            skippable frame: per document its id, whether the id is null, its number of ids
    seek table                skippable frame of the seekable zstandard format: per frame its compressed and
                              decompressed size and the low 32 bits of the XXH64 of its content, then the footer

A document lies within one frame. A reader takes the seek table from the end of
the file, the index before it, and decompresses only the frames that hold the
documents it wants; every frame's checksum is verified.

Documents are range-partitioned and sorted by id, so the files, in order, hold
ascending ids. A task writes its file under a name of its own attempt and
reports it as a row; only reported files count, so lost executors, retries and
speculative copies leave at most unused files.

Defined results: a null or empty text has the end id only. Null ids come
first. Repeated rows are written as often as they occur.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .byte_bpe import byte_bpe
from .common import quoted, shared_folder, written
from .textkit import pieces

QUERY = "op6_token_files"
ORACLE = None  # round trip and the library's ids in tests/llm/test_token_files.py

END_ID = 2
FRAME_IDS = 1 << 16  # a frame is closed once it has so many ids
LEVEL = 3

# Fixed values of the seekable zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
INDEX_MAGIC = 0x184D2A50
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80
FOOTER = struct.Struct("<IBI")
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])


class FrameWriter:
    """Writes documents one after the other; ``close`` adds the index and the seek table."""

    def __init__(self, out, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        self.out, self.most = out, frame_ids
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.open: list[np.ndarray] = []
        self.held, self.frames = 0, []
        self.ids, self.sizes = [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.sizes.append(len(ids))
        self.open.append(ids)
        self.held += len(ids)
        if self.held >= self.most:
            self._flush()

    def _flush(self) -> None:
        if not self.open:
            return
        raw = np.concatenate(self.open).astype("<u4").tobytes()
        packed = self.zstd.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.open, self.held = [], 0

    def close(self) -> None:
        self._flush()
        n = len(self.ids)
        index = b"".join([
            struct.pack("<Q", n), np.array([x or 0 for x in self.ids], "<i8").tobytes(),
            np.array([x is None for x in self.ids], "u1").tobytes(), np.array(self.sizes, "<u4").tobytes()])
        index = self.zstd.compress(index)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index) + 4) + index + struct.pack("<I", len(index)))
        table = np.array(self.frames, ENTRY).tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + FOOTER.size) + table
                       + FOOTER.pack(len(self.frames), HAS_CHECKSUMS, SEEKABLE_MAGIC))


class FrameReader:
    """Reads whole files or single documents of a seekable input of ``size`` bytes."""

    def __init__(self, source, size: int):
        self.source, self.zstd, self.unpacked = source, zstandard.ZstdDecompressor(), 0
        count, flags, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE_MAGIC or flags != HAS_CHECKSUMS:
            raise ValueError("not a file of frames with a seek table")
        head = size - FOOTER.size - count * ENTRY.itemsize - 8
        self.frames = np.frombuffer(self._at(head + 8, count * ENTRY.itemsize), ENTRY)
        (packed,) = struct.unpack("<I", self._at(head - 4, 4))
        index = self.zstd.decompress(self._at(head - 4 - packed, packed))
        (n,) = struct.unpack_from("<Q", index)
        self.ids = np.frombuffer(index, "<i8", n, 8)
        self.null = np.frombuffer(index, "u1", n, 8 + 8 * n).astype(bool)
        self.sizes = np.frombuffer(index, "<u4", n, 8 + 9 * n).astype(np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)])  # of documents, in ids
        self.places = np.concatenate([[0], np.cumsum(self.frames["packed"].astype(np.int64))])
        self.starts = np.concatenate([[0], np.cumsum(self.frames["size"].astype(np.int64) // 4)])  # of frames, in ids

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(int(place))
        return self.source.read(int(size))

    def frame(self, k: int) -> np.ndarray:
        """The ids of frame k, verified."""
        entry = self.frames[k]
        raw = self.zstd.decompress(self._at(self.places[k], entry["packed"]), max_output_size=int(entry["size"]))
        self.unpacked += 1
        if len(raw) != entry["size"] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != entry["check"]:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(raw, "<u4")

    def documents(self, wanted: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(place of the document, its ids) of the wanted places, ascending, or of all."""
        held, ids = -1, None
        for d in range(len(self.sizes)) if wanted is None else np.sort(wanted):
            k = int(np.searchsorted(self.starts, self.begins[d], side="right")) - 1
            if self.sizes[d] == 0:
                yield d, np.zeros(0, "<u4")
                continue
            if k != held:
                held, ids = k, self.frame(k)
            a = self.begins[d] - self.starts[k]
            yield d, ids[a:a + self.sizes[d]]

    def find(self, doc_id: int) -> np.ndarray:
        """Places of the documents with an id."""
        return np.flatnonzero((self.ids == doc_id) & ~self.null)


def write_files(docs: DataFrame, folder: str, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``docs`` to files under ``folder``; one row per file: file (order), path, n_docs, n_tokens."""
    spark = docs.sparkSession
    keyed = docs.select(F.col(quoted(doc_id)).cast("long").alias("doc"), F.col(quoted(text)).alias("text"))
    dealt = keyed.repartitionByRange(F.col("doc").asc_nulls_first()).sortWithinPartitions(F.col("doc").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex}.ids.zst"
        system, place = fs.FileSystem.from_uri(name)
        out = writer = None
        for batch in pieces(batches, "text"):
            if writer is None:
                system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                out = system.open_output_stream(place, compression=None)  # frames are compressed already
                writer = FrameWriter(out)
            ids, at = byte_bpe(path).encode(batch.column("text"))
            for doc, a, b in zip(batch.column("doc").to_pylist(), at, at[1:]):
                writer.add(doc, np.append(ids[a:b], END_ID))
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([context.partitionId()], pa.int32()), pa.array([name]),
                 pa.array([len(writer.sizes)], pa.int64()), pa.array([sum(writer.sizes)], pa.int64())],
                ["file", "path", "n_docs", "n_tokens"])

    return written(dealt.mapInArrow(run, "file int, path string, n_docs long, n_tokens long"), "token-files")


def read_files(files: DataFrame) -> DataFrame:
    """Documents of written files: doc_id, start (ids before it in all files), ids (array)."""
    return _read(files, "ids array<long>", lambda ids: pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())))


def _read(files: DataFrame, column: str, made) -> DataFrame:
    n = files.count()
    base = (F.sum("n_tokens").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, 0)) - F.col("n_tokens"))
    dealt = files.select("path", base.alias("base")).repartition(max(n, 1), "path")  # a row per file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_file(place) as source:
                    reader = FrameReader(source, source.size())
                    held: list[tuple[int, np.ndarray]] = []
                    for d, ids in reader.documents():
                        held.append((d, ids))
                        if len(held) == 1024:
                            yield told(reader, before, held)
                            held = []
                    if held:
                        yield told(reader, before, held)

    def told(reader: FrameReader, before: int, held: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        d = np.array([x[0] for x in held])
        return pa.RecordBatch.from_arrays(
            [pa.array(reader.ids[d], mask=reader.null[d]), pa.array(reader.begins[d] + before),
             pa.array(reader.sizes[d]), made([x[1] for x in held])],
            ["doc_id", "start", "n_tokens", column.split(" ")[0]])

    return dealt.mapInArrow(run, f"doc_id long, start long, n_tokens long, {column}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    folder = f"{shared_folder(spark)}/ids-{uuid.uuid4().hex}"
    files = write_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    return _read(files, "ids_crc32 long", lambda ids: pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()))
