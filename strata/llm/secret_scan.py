"""Secret scans: strong patterns, and weak parts linked by an interval join.

Each text is scanned once for strong spans (``assign``, ``access``, ``hex``)
and for weak parts that mean little alone: account identifiers, random-looking
secrets (of 20 characters or more, URL-safe ones included, without an upper
bound) and endpoints. Weak parts are then interval-joined: within a scope of
``scope`` code points, a weak secret counts if an identifier or an endpoint
starts there too, a weak identifier if a secret does, an endpoint if both do.
No part supports one that it overlaps: a secret inside an endpoint is not
supported by endpoints, and parts inside one do not support endpoints. So an
ordinary link with a mixed id in its path is left alone. Inside an endpoint a
token ends at a slash.

The join never pairs parts. Places are cut into buckets as wide as the scope;
per document, class and bucket only the first and last start are kept, which
is all that the question "does one lie within the scope" needs: in the same
bucket always, in a neighbouring one if its nearest start is close enough. A
document with a million parts therefore costs a million rows, not pairs.

Defined results: a null or empty text has no spans. Repeated rows (same id and
text) are linked once and each gets the same result; a null id is an id like
any other. ``redact`` passes other columns through.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import quoted, written
from .textkit import pieces

QUERY = "op9_secret_scan"
ORACLE = None  # see tests/llm/test_secret_scan.py: brute force over the pairs of parts

# The strong patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

# Weak parts.
IDENTIFIER = re.compile(
    r"""\b(?:user(?:name)?|login|client_?id|account_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]{3,})""",
    re.A | re.I)
LEAST_RANDOM = 20
# Whole tokens of any length, URL-safe ones and base64 padding included, and the pieces between their '-' and '_'.
RANDOM = re.compile(r"[A-Za-z0-9+/_-]{18,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
PIECE = re.compile(r"[A-Za-z0-9+/]{20,}")
# The same inside an endpoint, where '/' ends a token.
RANDOM_WITHIN = re.compile(r"[A-Za-z0-9+_-]{18,}(?:={1,2}(?![A-Za-z0-9+_=-]))?")
PIECE_WITHIN = re.compile(r"[A-Za-z0-9+]{20,}")
ENDPOINT = re.compile(
    r"""\b(?:[a-z][a-z0-9+.-]*://[^\s"'<>]+|(?:host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::[0-9]+)?)""",
    re.A | re.I)

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
_RANK = {kind: i for i, kind in enumerate(KINDS)}
# While parts are linked: identifiers and secrets inside an endpoint, by the kind they are.
WITHIN = {_RANK["identifier"]: 6, _RANK["secret"]: 7}
SCOPE = 256

_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_IDENTIFIER_WORDS = (b"user", b"login", b"client", b"account", b"access")
_ENDPOINT_WORDS = (b"://", b"host", b"endpoint", b"server")
_TO_HEX = bytes(1 if chr(b) in "0123456789abcdef" else 0 for b in range(256))
_TO_TOKEN = bytes(1 if chr(b).isascii() and (chr(b).isalnum() or chr(b) in "+/_=-") else 0 for b in range(256))
_DIGIT = re.compile(rb"[0-9]")
_MARKS = str.maketrans("", "", "-_=")


def strong_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the strong spans, by start and then kind as listed."""
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower()
    found = []
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if b"AKIA" in raw:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    if b"\1" * LEAST_HEX in raw.translate(_TO_HEX):
        found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], _RANK[x[1]]))


def _random(token: str) -> bool:
    """Digits, upper and lower case, mixed rather than as one capital or one number; '-', '_' and '=' don't count."""
    token = token.translate(_MARKS)
    kinds = (sum(c.isdigit() for c in token), sum(c.isupper() for c in token), sum(c.islower() for c in token))
    turns = sum(a.isalpha() != b.isalpha() or a.isupper() != b.isupper() for a, b in zip(token, token[1:]))
    return min(kinds) >= 2 and turns >= len(token) // 5


def _clear_of(spans: list[tuple[int, str, int]]) -> Callable[[int, int], bool]:
    """Whether a part (start, end) overlaps none of the spans, which are sorted by start."""
    starts, ends = [x[0] for x in spans], list(accumulate((x[2] for x in spans), max))

    def clear(start: int, end: int) -> bool:
        before = bisect_left(starts, end)  # spans that start before the part ends
        return not before or ends[before - 1] <= start
    return clear


def _secrets(text: str, clear: Callable[[int, int], bool], apart: Callable[[int, int], bool]) -> Iterator[tuple[int, int]]:
    """(start, end) of random-looking tokens; of a token that is not random or not clear as a whole, those of its pieces.

    ``apart``: whether a part lies outside all endpoints.
    """
    def tokens(start: int, end: int, whole: re.Pattern, piece: re.Pattern) -> Iterator[tuple[int, int]]:
        for m in whole.finditer(text, start, end):
            if len(m[0]) < LEAST_RANDOM:
                continue
            if clear(*m.span()) and _random(m[0]):
                yield m.span()
            else:
                yield from (x.span() for x in piece.finditer(text, *m.span()) if clear(*x.span()) and _random(x[0]))

    for m in RANDOM.finditer(text):
        yield from tokens(*m.span(), RANDOM, PIECE) if apart(*m.span()) else tokens(*m.span(), RANDOM_WITHIN, PIECE_WITHIN)


def endpoints(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the endpoints, by start."""
    return [(m.start(), "endpoint", m.end()) for m in ENDPOINT.finditer(text)]


def weak_parts(text: str, strong: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """(start, kind, end) of weak parts that overlap no strong span."""
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower()
    found = []
    if any(w in low for w in _IDENTIFIER_WORDS):
        found += [(m.start(), "identifier", m.end()) for m in IDENTIFIER.finditer(text)]
    there = endpoints(text) if any(w in low for w in _ENDPOINT_WORDS) else []
    found += there
    clear = _clear_of(strong)
    if b"\1" * LEAST_RANDOM in raw.translate(_TO_TOKEN) and _DIGIT.search(raw):
        found += [(a, "secret", b) for a, b in _secrets(text, clear, _clear_of(there))]
    return sorted((x for x in found if clear(x[0], x[2])), key=lambda x: (x[0], _RANK[x[1]]))


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, hash, text) to (doc, hash, the counts and spans)."""
    for batch in pieces(batches, "text"):
        strong, weak, digest = [], [], []
        for text in batch.column("text").to_pylist():
            spans = strong_spans(text or "")
            strong.append([{"start": a, "kind": _RANK[k], "end": b} for a, k, b in spans])
            parts = weak_parts(text or "", spans)
            apart = _clear_of(endpoints(text)) if any(k != "endpoint" for _, k, _ in parts) else None
            weak.append([{"start": a, "kind": _RANK[k] if k == "endpoint" or apart(a, b) else WITHIN[_RANK[k]], "end": b}
                         for a, k, b in parts])
            digest.append(hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, k, b in spans).encode()).hexdigest())
        counts = [pa.array([sum(x["kind"] == k for x in spans) for spans in strong], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("hash"), *counts, pa.array(digest, pa.string()),
             pa.array(strong, pa.list_(_SPAN)), pa.array(weak, pa.list_(_SPAN))],
            ["doc", "hash", "n_assign", "n_access", "n_hex", "base_sha256", "strong", "weak"])


_SCANNED = "n_assign long, n_access long, n_hex long, base_sha256 string, " \
    "strong array<struct<start:int,kind:int,`end`:int>>, weak array<struct<start:int,kind:int,`end`:int>>"


def link_parts(parts: DataFrame, keys: list[str], scope: int = SCOPE) -> DataFrame:
    """The weak parts that complementary parts of the same keys lie close to.

    ``parts`` has the key columns, kind (place in KINDS, or its code in WITHIN
    for a part inside an endpoint), start and end; access identifiers and
    assigned secrets take part as complements. Returned kinds are places in KINDS.
    """
    own = F.col("kind")
    for plain, code in WITHIN.items():
        own = F.when(F.col("kind") == code, plain).otherwise(own)
    cls = (F.when(F.col("kind") == WITHIN[_RANK["identifier"]], "inner identifier")
           .when(F.col("kind") == WITHIN[_RANK["secret"]], "inner secret")
           .when(F.col("kind").isin(_RANK["access"], _RANK["identifier"]), "identifier")
           .when(F.col("kind").isin(_RANK["assign"], _RANK["secret"]), "secret").otherwise("endpoint"))
    parts = parts.withColumn("cls", cls).withColumn("bucket", F.floor(F.col("start") / scope))
    near = (parts.groupBy(*keys, "cls", "bucket").agg(F.min("start").alias("low"), F.max("start").alias("high"))
            .withColumn("shift", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
            .select(*[F.col(k).alias(f"near_{k}") for k in keys], F.col("cls").alias("near_cls"),
                    (F.col("bucket") + F.col("shift")).alias("near_bucket"), "low", "high", "shift"))
    weak = parts.where(F.col("kind").isin(_RANK["identifier"], _RANK["secret"], _RANK["endpoint"], *WITHIN.values()))
    on = F.col("bucket") == F.col("near_bucket")
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"near_{k}"))
    close = (F.when(F.col("shift") == 0, F.lit(True))
             .when(F.col("shift") == 1, F.col("high") >= F.col("start") - scope)
             .otherwise(F.col("low") <= F.col("start") + scope))
    met = weak.join(near, on & close & (F.col("cls") != F.col("near_cls")))
    flags = met.groupBy(*keys, "start", "kind", "end").agg(
        *[F.bool_or(F.col("near_cls") == c).alias(c) for c in ("identifier", "inner identifier", "secret", "inner secret", "endpoint")])
    by_identifier, by_secret = (F.col(c) | F.col(f"inner {c}") for c in ("identifier", "secret"))
    told = (F.when(F.col("kind") == _RANK["secret"], by_identifier | F.col("endpoint"))
            .when(F.col("kind") == WITHIN[_RANK["secret"]], by_identifier)
            .when(F.col("kind") == _RANK["endpoint"], F.col("identifier") & F.col("secret"))
            .otherwise(by_secret))
    return flags.where(told).select(*keys, "start", own.cast("int").alias("kind"), "end")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs``: doc, hash (of the text), n_assign, n_access, n_hex, base_sha256, spans.

    ``spans`` is an array of (start, kind, end), by start and then kind, with
    the linked weak parts among the strong spans. The scan itself is written
    once to the shared folder, as two branches read it.
    """
    keyed = docs.select(F.col(quoted(doc_id)).alias("doc"), F.xxhash64(F.col(quoted(text))).alias("hash"),
                        F.col(quoted(text)).alias("text"))
    schema = f"doc {keyed.schema['doc'].dataType.simpleString()}, hash long, {_SCANNED}"
    found = written(keyed.mapInArrow(_scan, schema), "secret-scan")
    parts = (found.where(F.size("weak") > 0).select("doc", "hash", F.explode(F.concat("strong", "weak")).alias("p"))
             .where(F.col("p.kind") != _RANK["hex"]).select("doc", "hash", "p.*").distinct())
    added = link_parts(parts, ["doc", "hash"], scope).groupBy("doc", "hash").agg(
        F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    added = added.select(F.col("doc").alias("of_doc"), F.col("hash").alias("of_hash"), "more")
    joined = found.join(added, found["doc"].eqNullSafe(added["of_doc"]) & (found["hash"] == added["of_hash"]), "left")
    none = F.array().cast("array<struct<start:int,kind:int,`end`:int>>")
    return joined.select("doc", "hash", "n_assign", "n_access", "n_hex", "base_sha256",
                         F.array_sort(F.concat("strong", F.coalesce("more", none))).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mark: str = "<SECRET>",
           scope: int = SCOPE) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans are replaced as one."""
    hits = scan(docs, doc_id, text, scope).where(F.size("spans") > 0).dropDuplicates(["doc", "hash"]).select(
        F.col("doc").alias("of_doc"), F.col("hash").alias("of_hash"), "spans")
    body, columns = F.col(quoted(text)), docs.columns
    row = docs.select(F.struct(*[F.col(quoted(c)) for c in columns]).alias("row"), body.alias("text"),
                      F.col(quoted(doc_id)).alias("doc"), F.xxhash64(body).alias("hash"))
    joined = row.join(hits, F.col("doc").eqNullSafe(F.col("of_doc")) & (F.col("hash") == F.col("of_hash")), "left")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    done = F.aggregate("spans", start, lambda acc, x: F.when(x["end"] <= acc["at"], acc).otherwise(F.struct(
        F.when(x["start"] < acc["at"], acc["out"]).otherwise(F.concat(
            acc["out"], F.substring(F.col("text"), acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))).alias("out"),
        x["end"].alias("at"))))
    joined = joined.withColumn("done", F.when(F.col("spans").isNotNull(), done))
    clean = F.when(F.col("done").isNull(), F.col("text")).otherwise(
        F.concat("done.out", F.substring(F.col("text"), F.col("done.at") + 1, F.length("text"))))
    return joined.select(*[clean.alias(c) if c == text else F.col(f"row.{quoted(c)}") for c in columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).select(F.col("doc").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256",
                             spans_text(F.col("spans")).alias("spans"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document stays, its secrets are replaced."""
    kind = docs.schema["n_chars"].dataType
    return redact(docs).withColumn("n_chars", F.length("text").cast(kind))
