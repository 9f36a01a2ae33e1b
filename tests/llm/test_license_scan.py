"""License scan: base places against plain Python, diagonals and merging, awkward rows, the SQL."""

import math
import random
import re

import duckdb
import pyarrow as pa

from corpus_rows import AWKWARD, docs_of, folder  # noqa: F401
from strata.llm import license_scan as lic


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base(text):
    w = words(text)
    return sorted((i, label) for phrase, label in lic.PHRASES.items() for i in range(len(w))
                  if w[i:i + len(phrase.split())] == phrase.split())


def rows():
    mit = lic.TEXTS["mit-text"].split()
    return AWKWARD + [
        (20, "x y z " + " ".join(mit) + " MIT License, cc-by cc by"), (21, " ".join(mit[:20] + ["foo", "bar"] + mit[20:])),
        (22, " ".join(mit[:30])), (23, "GNU General-Public\nLICENSE"), (24, " ".join(mit).upper() + lic.TEXTS["gpl-text"]),
        (25, "cc byK apacKe license cc by" + " cc by" * 50), (26, " ".join(mit[:10] + mit[12:40] + ["q"] * 9 + mit[40:])),
        *[(40 + k, " ".join(mit[:25] + ["of", "the"] * k + mit[25 + k:])) for k in range(12)],
        (28, " ".join("zzz" if i % 5 == 4 else x for i, x in enumerate(mit))), (29, " ".join(mit[30:] + mit[:30])),
        (27, "gnu general public gnu general public license license")]


def test_base_places_and_labels(docs_of):
    got = lic.license_scan(docs_of(rows())).collect()
    assert len(got) == len(rows())
    for r in got:
        places = base(r.text)
        assert (r.n_words, r.n_base) == (len(words(r.text)), len(places)), r.doc_id
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({p[1] for p in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and r["a.b"] == "z"
    by = {r.doc_id: r for r in got}
    assert "mit-text" in by[20].labels and by[21].labels == "mit-text" and by[26].labels == "mit-text"
    assert by[22].labels == "" and 0.3 < by[22].score < 0.8
    assert "gpl-text" in by[24].labels and "mit-text" in by[24].labels


def test_every_copy_of_the_least_share_is_found(docs_of):
    """Words changed anywhere, up to 1 - LEAST_SHARE of a template: the share of unchanged words, counted here one by one, is a lower bound."""
    rng = random.Random(3)
    cases = []
    for label, text in lic.TEXTS.items():
        w = text.split()
        most = math.floor(len(w) * (1 - lic.LEAST_SHARE) + 1e-9)
        for changed in [range(most), range(len(w) - most, len(w)), [i * 5 + 4 for i in range(most)],
                        *[rng.sample(range(len(w)), most) for _ in range(12)]]:
            copy = ["zzz" if i in set(changed) else x for i, x in enumerate(w)]
            cases.append((label, sum(a == b for a, b in zip(copy, w)) / len(w), ["before"] * rng.randrange(9) + copy + ["after"]))
    got = {r.doc_id: r for r in lic.license_scan(docs_of([(i, " ".join(c[2])) for i, c in enumerate(cases)])).collect()}
    for i, (label, share, copy) in enumerate(cases):
        assert label in got[i].labels.split(",") and got[i].score >= share >= lic.LEAST_SHARE, (label, copy)


def test_long_insertions_and_omissions_are_joined(docs_of):
    mit = lic.TEXTS["mit-text"].split()
    n = len(mit)
    docs = [(k, " ".join(mit[:25] + [f"w{i}" for i in range(k)] + mit[25:])) for k in (9, 12, 40, n)]
    docs += [(200, " ".join(mit[:20] + mit[31:])), (201, " ".join(mit[:25] + [f"w{i}" for i in range(n + 1)] + mit[25:])),
             (202, " ".join(mit[:30] + ["w"] * 20 + mit[:30]))]
    got = {r.doc_id: r for r in lic.license_scan(docs_of(docs)).collect()}
    assert all((got[k].labels, got[k].score) == ("mit-text", 1.0) for k in (9, 12, 40, n))
    # an omitted word may stand by chance where the other diagonal expects it
    assert got[200].labels == "mit-text" and (n - 11) / n <= got[200].score <= (n - 9) / n
    assert got[201].labels == "" and got[201].score == (n - 25) / n  # further apart than the template is long: two parts
    assert got[202].labels == "" and got[202].score == 30 / n        # one half twice is no whole


def test_sql_agrees(spark, folder):
    table = pa.table({"doc_id": pa.array([r[0] for r in rows() if r[0]], pa.int64()),
                      "text": pa.array([r[1] for r in rows() if r[0]], pa.string())})
    unique = table.to_pandas().drop_duplicates("doc_id")
    d = folder(documents=pa.Table.from_pandas(unique, preserve_index=False))
    got = {r.doc_id: tuple(r) for r in lic.query(spark, d).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    names = lic.query(spark, d).columns
    want = {r[0]: r for r in con.execute(f"SELECT {', '.join(names)} FROM ({lic.ORACLE})").fetchall()}
    assert got == want


def test_empty_table(spark):
    assert lic.license_scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
