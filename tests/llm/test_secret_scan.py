"""Secret scan: strong spans by plain patterns, linked parts against all pairs, redaction, awkward rows."""

import hashlib
import random
import re

from corpus_rows import AWKWARD, docs_of  # noqa: F401
from pyspark.sql import functions as F

from strata.llm import secret_scan as s

PLAIN = {
    "assign": (r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
    "access": (r"(AKIA[A-Z0-9]+)", 16),
    "hex": (r"([0-9a-f]+)", 32),
}


def base(text):
    found = [(m.start(), i, kind, m.end()) for i, (kind, (p, least)) in enumerate(PLAIN.items())
             for m in re.finditer(p, text or "") if len(m[1]) >= least]
    return [(a, kind, b) for a, _, kind, b in sorted(found)]


def rows():
    rng = random.Random(4)
    bits = ["password", "PASSWD", "token", " = ", ": ", "\"", "abcdefgh12", "AKIA", "ABCDEFGHIJKL", "0123456789abcdef", "\n",
            " ", "é🙂", "toKen", "ſecret", "api_key", "x", "https://h.example/p", "user=bob77", "aB3dE5gH7jK9mN1pQ3rS5"]
    return AWKWARD + [(100 + i, "".join(rng.choice(bits) for _ in range(40))) for i in range(150)]


def test_base_spans_match_plain_patterns(docs_of):
    got = s.scan(docs_of(rows())).collect()
    assert len(got) == len(rows())
    text = dict(rows())
    for r in got:
        if r.doc in (6, None):
            continue
        spans = base(text[r.doc])
        joined = ",".join(f"{k}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for _, k, _ in spans) for x in s.KINDS[:3]]
        assert set(spans) <= {(x.start, s.KINDS[x.kind], x.end) for x in r.spans}


def test_linked_parts_match_all_pairs(spark):
    rng = random.Random(1)
    parts = {(d, 0, rng.randrange(6), rng.randrange(6000)) for d in range(6) for _ in range(40)}
    parts = [(d, h, k, a, a + 5) for d, h, k, a in parts if k != 2]
    cls = {0: "secret", 4: "secret", 1: "identifier", 3: "identifier", 5: "endpoint"}
    want = set()
    for d, _, k, a, b in parts:
        near = {cls[k2] for d2, _, k2, a2, _ in parts if d2 == d and abs(a2 - a) <= 256} - {cls[k]}
        if (k == 4 and near) or (k == 3 and "secret" in near) or (k == 5 and {"identifier", "secret"} <= near):
            want.add((d, a, k, b))
    df = spark.createDataFrame(parts, "doc long, hash long, kind int, start int, end int")
    got = {(r.doc, r.start, r.kind, r.end) for r in s.link_parts(df, ["doc", "hash"]).collect()}
    assert got == want and want


def test_weak_parts_need_company(docs_of):
    secret = "aB3dE5gH7jK9mN1pQ3rS5tU7vW9xY1zA3bC5dE7f"
    got = {r.doc: [s.KINDS[x.kind] for x in r.spans] for r in s.scan(docs_of([
        (1, f"user = bob1 at https://x.example.com/a key {secret} end"), (2, f"only {secret} here"),
        (3, "see https://x.example.com/a for more"), (4, f"user = bob1 {'far away ' * 100} {secret}")])).collect()}
    assert got == {1: ["identifier", "endpoint", "secret"], 2: [], 3: [], 4: []}


def test_redaction_replaces_spans_only(docs_of):
    docs = docs_of(rows()).select("*", F.length("text").alias("n_chars"))
    out = s.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    spans = {r.doc: r.spans for r in s.scan(docs).collect()}
    text = dict(rows())
    for r in out.collect():
        if r.doc_id is None or r.doc_id == 6:
            continue
        want, at = "", 0
        for x in spans[r.doc_id]:
            if x.start >= at:
                want += text[r.doc_id][at:x.start] + "<SECRET>"
            at = max(at, x.end)
        assert r.text == (None if text[r.doc_id] is None else want + text[r.doc_id][at:])


def test_empty_table(spark):
    assert s.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_weak_parts_match_all_pairs():
    url = "https://db.example.org/x?user=alice&token=abcdefgh1234"
    assert s.weak_parts(url, s.strong_spans(url)) == [(25, "identifier", 35)]
    texts = [t for _, t in rows() if t] + [url + " " + url, f"{url}&login=bob77 server=h.example {url}"]
    lost = 0
    for text in texts:
        strong, parts = s.strong_spans(text), s.weak_parts(text, [])
        want = [(a, k, b) for a, k, b in parts if not any(a < d and c < b for c, _, d in strong)]
        got = s.weak_parts(text, strong)
        assert [x for x in got if x[1] != "secret"] == [x for x in want if x[1] != "secret"]
        assert set(want) <= set(got) and not any(a < d and c < b for a, _, b in got for c, _, d in strong)
        lost += len(parts) - len(want)
    assert lost


def test_identifier_in_an_endpoint_is_linked_and_redacted(docs_of):
    docs = docs_of([(1, "https://db.example.org/x?user=alice&token=abcdefgh1234 end")])
    assert [r.text for r in s.redact(docs).collect()] == ["https://db.example.org/x?<SECRET>&<SECRET> end"]


def test_long_and_url_safe_tokens(docs_of):
    rng = random.Random(6)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    token = lambda n, more: "".join(rng.choice(letters + more) for _ in range(n - 2)) + "a1"
    tokens = [token(n, more) for n in (20, 100, 101, 300, 5000) for more in ("", "+/", "-_")]
    tokens += ["aB3dE5-gH7jK9_mN1pQ3-rS5tU7_vW9xY1", token(62, "+/") + "==", "aB3dE5gH7jK9mN1pQ3=="]
    docs = docs_of([(i, f"user=alice key {x} end") for i, x in enumerate(tokens)])
    for r in s.scan(docs).collect():
        assert [(x.start, s.KINDS[x.kind], x.end) for x in r.spans] == [
            (0, "identifier", 10), (15, "secret", 15 + len(tokens[r.doc]))]
    assert {r.text for r in s.redact(docs).collect()} == {"<SECRET> key <SECRET> end"}


def test_pieces_of_longer_tokens():
    piece = "aB3dE5gH7jK9mN1pQ3rS5"
    plain = "-and-a-long-tail-of-plain-words" * 9
    for text, start in ((piece + plain, 0), (f"sig={piece}", 4), (f"{piece}-token: abcdefgh1234", 0)):
        assert [x for x in s.weak_parts(text, s.strong_spans(text)) if x[1] == "secret"] == [(start, "secret", start + len(piece))]
    for text in ("a" * 20_000 + "1", "-" * 500 + "1", "=" * 500 + "1", "some-long-plain-words-2024-01-15-report"):
        assert not s.weak_parts(text, [])


def test_ordinary_links_are_left_alone(docs_of):
    mixed = "aB3dE5fG7hI9jK1lM3nO5pQ7"
    links = [f"see https://cdn.example.org/{mixed} for the picture", f"https://v.example.com/watch/{mixed}/part?x={mixed}#t",
             f"get ftp://files.example.net/a/{mixed}.zip and https://cdn.example.org/{mixed}", f"//cdn.example.org/{mixed}",
             f"host: img.example.org https://img.example.org/{mixed}/{mixed}"]
    docs = docs_of(list(enumerate(links)))
    assert [len(r.spans) for r in s.scan(docs).collect()] == [0] * len(links)
    assert {r.doc_id: r.text for r in s.redact(docs).collect()} == dict(enumerate(links))


def test_parts_inside_one_endpoint(docs_of):
    mixed = "aB3dE5fG7hI9jK1lM3nO5pQ7"
    got = {r.doc: [(s.KINDS[x.kind], x.start, x.end) for x in r.spans] for r in s.scan(docs_of([
        (1, f"https://db.example.org/{mixed}?user=alice"),         # linked with each other, not with the endpoint
        (2, f"user=alice gets https://db.example.org/p/{mixed}"),  # the token alone, without the host
        (3, f"{mixed} at https://db.example.org/p"),               # a secret beside an endpoint
        (4, f"https://db.example.org/?user=alice and {mixed}"),    # the identifier inside it and the secret outside
    ])).collect()}
    assert got[1] == [("secret", 23, 47), ("identifier", 48, 58)]
    assert got[2] == [("identifier", 0, 10), ("secret", 41, 65)]
    assert got[3] == [("secret", 0, 24)]
    assert got[4] == [("identifier", 24, 34), ("secret", 39, 63)]


def test_inner_parts_match_all_pairs(spark):
    rng = random.Random(2)
    parts = sorted({(d, 0, rng.choice([0, 1, 3, 4, 5, 6, 7]), rng.randrange(6000)) for d in range(6) for _ in range(40)})
    parts = [(*p, p[3] + 5) for p in parts]
    cls = {0: "secret", 4: "secret", 7: "inner secret", 1: "identifier", 3: "identifier", 6: "inner identifier", 5: "endpoint"}
    want = set()
    for d, _, k, a, b in parts:
        near = {cls[k2] for d2, _, k2, a2, _ in parts if d2 == d and abs(a2 - a) <= 256}
        ident, secret = {"identifier", "inner identifier"} & near, {"secret", "inner secret"} & near
        if (k == 4 and (ident or "endpoint" in near) or k == 7 and ident or k in (3, 6) and secret
                or k == 5 and {"identifier", "secret"} <= near):
            want.add((d, a, {6: 3, 7: 4}.get(k, k), b))
    df = spark.createDataFrame(parts, "doc long, hash long, kind int, start int, end int")
    got = {(r.doc, r.start, r.kind, r.end) for r in s.link_parts(df, ["doc", "hash"]).collect()}
    assert got == want and want
