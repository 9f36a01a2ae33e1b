"""Token counts, token files, packing and SentencePiece encoding against the libraries and brute force."""

import io
import random
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpus_rows import AWKWARD, docs_of  # noqa: F401
import sentencepiece
from tokenizers import Tokenizer

from strata.llm import byte_bpe, packing, token_count, token_files, viterbi

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def noise(n, seed, signs):
    rng = random.Random(seed)
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 50))) for _ in range(n)]


SIGNS = list("abcsdtmrevl''  \n\t.,!0123éßñ½\xa0\x85\x1c–’漢🙂▁<>") + ["'s", "'re", "  ", "the ", "ing", "<s>", "</s>"]
TEXTS = noise(1500, 1, SIGNS) + [t for _, t in AWKWARD] + [" " * 700, "ab" * 400, "x<|endoftext|>y", "<unk><0x0A>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_byte_bpe_ids_are_the_librarys(library):
    encoder = byte_bpe.ByteBpe(BPE)
    for part in (TEXTS, [t for t in TEXTS if t and t.isascii() and "<|" not in t]):  # with and without the library's share
        ids, at = encoder.encode(pa.array(part, pa.string()))
        for t, a, b in zip(part, at, at[1:]):
            assert ids[a:b].tolist() == ids_of(library, t), repr(t)


def test_table_that_overflows_is_met_again(library, monkeypatch):
    encoder = byte_bpe.ByteBpe(BPE)
    encoder.table.most = 50
    for t in ("some words to start with", "quite different words follow here " * 3, "some words again"):
        ids, _ = encoder.encode(pa.array([t]))
        assert ids.tolist() == ids_of(library, t)


def test_token_counts_are_the_librarys():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = token_count.count_tokens(PIECES, pa.array(TEXTS, pa.string()))
    assert got.tolist() == [len(model.encode(t or "")) for t in TEXTS]


def test_rounds_and_heap_agree():
    model = token_count.piece_model(PIECES)
    units = [u.replace(" ", "▁") for u in noise(300, 4, list("abcdething 0é")) if u]
    ids, at = token_count.symbols(model, units)
    rounds = token_count.merge_rounds(model, ids.copy(), at)
    assert rounds.tolist() == [token_count.merge_heap(model, ids[a:b].copy()) for a, b in zip(at, at[1:])]


def test_token_count_frame(docs_of):
    out = token_count.token_count(docs_of(AWKWARD), PIECES, limit=100).collect()
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in out:
        assert (r.n_bytes, r.n_tokens) == (len((r.text or "").encode()), len(model.encode(r.text or "")))
        assert r.over_limit == (r.n_tokens > 100) and r["a.b"] == "z"


def best_score(model, text):
    """Greatest sum of scores over all segmentations, by the whole table."""
    table, unknown, longest = viterbi._search_table(model)
    best = [0.0] + [None] * len(text)
    for i in range(len(text)):
        for n in range(1, min(longest, len(text) - i) + 1):
            found = table.get(text[i:i + n])
            score = found[0] if found and found[0] is not None else unknown if n == 1 else None
            if score is not None and (best[i + n] is None or best[i] + score > best[i + n]):
                best[i + n] = best[i] + score
    return best[-1]


def test_viterbi_is_optimal_and_round_trips():
    model = token_count.piece_model(PIECES)
    ids, at = viterbi.encode(PIECES, pa.array(TEXTS, pa.string()))
    score = {i: model.score[p] for p, i in model.piece.items()}
    unknown = viterbi._search_table(model)[1]
    bytes_ = {i: b for b, i in model.byte.items()}
    for t, a, b in zip(TEXTS[:600], at, at[1:]):
        own = ids[a:b].tolist()
        assert viterbi.decode(model, own) == (t or "").replace("▁", " ").encode()
        heads = sum(i in bytes_ and bytes_[i] & 0xC0 != 0x80 for i in own)  # unknown characters, by their first bytes
        if t:
            assert sum(score.get(i, 0) for i in own) + heads * unknown == best_score(model, ("▁" + t).replace(" ", "▁"))


def test_viterbi_streams_with_a_small_window():
    model = token_count.piece_model(PIECES)
    text = "The cat sat on the mat, " * 400 + "qwertyuiopasdfgh" * 50
    for size in (1, 7, 1000):
        chunks = [text[i:i + size] for i in range(0, len(text), size)]
        parts = list(viterbi.encode_stream(model, chunks))
        ids, _ = viterbi.encode(PIECES, pa.array([text]))
        assert [i for p in parts for i in p] == ids.tolist() and (size > 100 or len(parts) > 100)
    search, most = viterbi.StreamingViterbi(model), 0
    for c in "▁" + text.replace(" ", "▁"):
        search.feed(c)
        most = max(most, len(search.back))
    assert most < 100


def test_sentencepiece_frames_round_trip(docs_of):
    encoded = viterbi.sentencepiece_encode(docs_of(AWKWARD), PIECES)
    for r in viterbi.sentencepiece_decode(encoded, PIECES).collect():
        assert r.round_trip and r.decoded == (r.text or "").replace("▁", " ") and r.n_ids == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())


# ---------------------------------------------------------------- files

def test_reader_unpacks_only_the_frames_it_needs_and_sees_damage():
    rng = np.random.default_rng(0)
    docs = [(i * 2 if i % 7 else None, rng.integers(0, 50_000, rng.integers(0, 90))) for i in range(200)]
    out = io.BytesIO()
    writer = token_files.FrameWriter(out, frame_ids=300)
    for doc, ids in docs:
        writer.add(doc, ids)
    writer.close()
    size = out.tell()
    reader = token_files.FrameReader(out, size)
    for (doc, ids), (place, got) in zip(docs, reader.documents()):
        assert (got == ids).all() and (None if reader.null[place] else reader.ids[place]) == doc
    assert reader.unpacked == len(reader.frames) > 10
    single = token_files.FrameReader(out, size)
    place = single.find(100)
    assert [(d, x.tolist()) for d, x in single.documents(place)] == [(50, docs[50][1].tolist())] and single.unpacked == 1
    raw = bytearray(out.getvalue())
    raw[int(reader.places[2]) + 12] ^= 0x55
    with pytest.raises(Exception):
        list(token_files.FrameReader(io.BytesIO(bytes(raw)), size).documents())


def test_files_hold_all_documents_in_order(docs_of, tmp_path, library):
    files = token_files.write_files(docs_of(AWKWARD), f"file://{tmp_path}/ids", BPE)
    got = token_files.read_files(files).orderBy("start").collect()
    want = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [d for d, _ in want]
    assert sorted(map(str, (r.ids for r in got))) == sorted(str(ids_of(library, t) + [2]) for _, t in want)
    start = 0
    for r in got:
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        start += r.n_tokens


def test_no_documents_no_files(spark, tmp_path):
    files = token_files.write_files(spark.createDataFrame([], "doc_id long, text string"), f"file://{tmp_path}/ids", BPE)
    assert files.count() == 0 and token_files.read_files(files).count() == 0


# ---------------------------------------------------------------- packing

def test_cut():
    assert packing.cut(1024, 1024) == [(0, 1024)] and packing.cut(1025, 1024) == [(0, 1), (1, 1024)]
    assert packing.cut(2048, 1024) == [(0, 1024), (1024, 1024)] and packing.cut(1, 1024) == [(0, 1)]


def test_fullest_combination_is_the_best_there_is():
    rng = random.Random(8)
    for _ in range(200):
        items = [rng.randint(1, 30) for _ in range(rng.randint(1, 8))]
        counts = {n: items.count(n) for n in items}
        chosen = packing.fullest(counts, 40)
        top = max(items)
        rest = list(items)
        rest.remove(top)
        best = max(sum(c) for k in range(len(rest) + 1) for c in combinations(rest, k) if top + sum(c) <= 40) + top
        assert sum(n * k for n, k in chosen.items()) == best and all(k <= counts[n] for n, k in chosen.items())


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by)


def test_packing_is_valid_and_tight(docs_of, library):
    rng = random.Random(3)
    rows = AWKWARD + [(100 + i, "word " * rng.choice([2, 3, 5, 17, 40, 40, 40, 61, 90, 150])) for i in range(300)]
    out = packing.pack(packing.token_pieces(docs_of(rows), BPE, 128, with_ids=True), 128).collect()
    sequences = check_packing(out, 128)
    total = sum(r.length for r in out)
    assert sequences <= -(-total // 128) * 1.02 + 1
    parts = {}
    for r in out:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        parts.setdefault(r.doc_id, []).append((r.piece, r.start, r.ids))
    for doc, text in rows:
        if doc is not None and doc != 6:
            own = sorted(parts[doc])
            assert [i for p in own for i in p[2]] == ids_of(library, text) + [2]
            assert all(len(p[2]) == 128 for p in own[1:])
    assert sum(len(ids_of(library, t)) + 1 for _, t in rows) == total


def test_no_pieces(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.token_pieces(none, BPE)).count() == 0
