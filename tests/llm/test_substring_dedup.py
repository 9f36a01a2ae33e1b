"""Substring dedup: against brute force, the SQL, compaction of paths, awkward rows."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

from corpus_rows import AWKWARD, docs_of, folder  # noqa: F401
from strata.llm import substring_dedup as sd
from strata.llm.common import row_keys

K = sd.WINDOW


def brute(rows):
    docs = [re.findall("[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + K]) for w in docs for i in range(len(w) - K + 1))
    out = []
    for (doc_id, _), w in zip(rows, docs):
        gone = {j for i in range(len(w) - K + 1) if seen[tuple(w[i:i + K])] > 1 for j in range(i, i + K)}
        kept = " ".join(v for j, v in enumerate(w) if j not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    fresh = lambda k: [f"w{rng.randrange(4000)}" for _ in range(k)]
    shared = [fresh(rng.choice([34, 35, 36, 50, 120, 400])) for _ in range(12)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            part = rng.choice(shared) if rng.random() < 0.5 else fresh(rng.randint(0, 150))
            part = part[rng.randint(0, 20) if rng.random() < 0.3 else 0:]
            if rng.random() < 0.3 and part:
                part = part[:]
                part[rng.randrange(len(part))] = "changed"
            words += part
        rows.append((i, " ".join(words)))
    rows += [(500 + i, rows[i][1]) for i in range(5)] + [rows[7], rows[7]]
    rows += [(600, "one two " * 60), (601, "x " * 40), (602, " ".join(shared[4] + shared[4]))]
    return rows


def got(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_random_corpus(docs_of, seed):
    rows = corpus(seed)
    assert got(sd.substring_dedup(docs_of(rows).repartition(5))) == brute(rows)


def test_awkward_rows_and_texts(docs_of):
    rows = AWKWARD + [(30, "é漢 🙂 x " * 30 + "tail"), (None, "n o p " * 13), (31, " ".join(f"v{i}" for i in range(35))),
                      (31, " ".join(f"v{i}" for i in range(35))), (32, "A " + " ".join(f"v{i}" for i in range(34)))]
    df = sd.substring_dedup(docs_of(rows), with_text=True)
    assert got(df) == brute(rows)
    for r in df.collect():
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
        assert sum(s.end - s.start for s in r.removed) == r.n_removed


def test_one_passage_in_many_documents(docs_of):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(300))
    rows = [(i, " ".join([f"a{rng.random()}" for _ in range(20)] + [passage] + [f"b{rng.random()}" for _ in range(20)])) for i in range(60)]
    df = docs_of(rows)
    assert got(sd.substring_dedup(df)) == brute(rows)
    keyed = row_keys(df)
    found = sd.piece_table(keyed)
    paths = sd.compacted(sd.distinct_pieces(found).where("copies > 1")).collect()
    assert len(paths) == 1 and paths[0].copies == 60  # one path for the whole passage but for its outer pieces
    assert 300 - K + 1 - 2 * (K - sd.GRAM + 1) <= paths[0].edges <= 300 - K + 1


def test_paths_end_where_they_branch(docs_of):
    a, b, c = ([f"{x}{i}" for i in range(150)] for x in "abc")
    rows = [(1, " ".join(a + b)), (2, " ".join(a + b)), (3, " ".join(a + c)), (4, " ".join(a + c))]
    df = docs_of(rows)
    paths = sd.compacted(sd.distinct_pieces(sd.piece_table(row_keys(df))).where("copies > 1")).collect()
    assert sorted(p.copies for p in paths) == [2, 2, 4]
    assert got(sd.substring_dedup(df)) == brute(rows)


def test_a_false_digest_takes_nothing_out(docs_of, monkeypatch):
    rows = [(i, " ".join(f"p{j}" for j in range(200))) for i in range(2)]
    monkeypatch.setattr(sd, "read_sources", lambda docs, paths, shared: paths.selectExpr(
        "0 AS kind", "head AS name", "0L AS place", "1L AS a", "2L AS b"))
    assert {r.n_removed for r in sd.substring_dedup(docs_of(rows)).collect()} == {0}


def test_empty_table(docs_of):
    assert sd.substring_dedup(docs_of([(1, "a")]).limit(0)).collect() == []


def test_sql_agrees(spark, folder):
    rows = corpus(8, 60) + AWKWARD
    d = folder(documents=pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())}))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    df = sd.query(spark, d)
    assert df.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert got(df) == sorted(con.execute(sd.ORACLE).fetchall(), key=str)
