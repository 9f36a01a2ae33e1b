"""License scans by diagonal voting.

Rolling word k-grams of every text are hashed and joined to the positions of
the same k-grams in the templates. A hit at text word p and template word t
votes for the diagonal p - t. Votes are summed per diagonal; neighbouring
diagonals (words added or left out in a copy) are merged; runs of diagonals that
continue each other in the template are joined across an insertion or an omission of up to
the template's length; the spans that get enough votes are verified word by
word. Enough is what a copy with the least share to report must still have,
wherever its changed words are (``least_votes``).

Short phrases vote with 2-grams and must get every vote of one diagonal, which
is the phrase standing there word for word. Longer templates vote with 4-grams;
their verified share is the share of template words found on the merged
diagonals. A copy whose changed words take up to 1 - LEAST_SHARE of the template is
always found; a moved stretch counts if it keeps four words in a row.

The template side is broadcast: it is a parameter of the operator, checked to
have at most MAX_TEMPLATE_WORDS words. Text k-grams are never shuffled; only
hits are, summed per document, template and diagonal, so a license repeated in
a third of the documents spreads over the documents' keys.

Defined results: null and empty texts have no words, no labels and score 0.
Repeated rows (same id and text) vote once and get equal results. Other
columns pass through; an input column named like a result is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import quoted, written

QUERY = "op2_license_scan"

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Opening passages of public license texts and their labels.
TEXTS = {
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                "associated documentation files the software to deal in the software without restriction including "
                "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                "copies of the software and to permit persons to whom the software is furnished to do so",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted "
                "provided that the following conditions are met redistributions of source code must retain the above "
                "copyright notice this list of conditions and the following disclaimer",
    "isc-text": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
                "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "apache-text": "you may not use this file except in compliance with the license you may obtain a copy of the "
                   "license at http www apache org licenses license 2 0 unless required by applicable law or agreed to "
                   "in writing software distributed under the license is distributed on an as is basis",
    "gpl-text": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                "general public license as published by the free software foundation either version 3 of the license "
                "or at your option any later version",
    "mpl-text": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the "
                "mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "public-domain-text": "this is free and unencumbered software released into the public domain anyone is free to "
                          "copy modify publish use compile sell or distribute this software either in source code form "
                          "or as a compiled binary for any purpose commercial or non commercial and by any means",
}

SHORT, LONG = 2, 4          # words in a voting k-gram of phrases and of longer templates
MAX_TEMPLATE_WORDS = 20_000
MAX_BROADCAST = 500_000     # texts to verify: their hashes (8 bytes each) are broadcast up to so many, else shuffled
GAP = 8                     # diagonals up to so many words apart are merged
LEAST_SHARE = 0.8           # verified share from which a template's label is reported
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def text_words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; a null text has none.

    ``lower`` maps one more character to an ASCII letter, the Kelvin sign; it
    is put aside so that only A-Z become a-z.
    """
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(low, SEPARATORS), "")


def least_votes(n_words: int) -> int:
    """Votes that a copy of a template keeps at least when 1 - LEAST_SHARE of its words change and it is cut once.

    A changed word spoils LONG k-grams at most, an insertion LONG - 1."""
    changed = math.floor(n_words * (1 - LEAST_SHARE) + 1e-9)
    return max(1, n_words - (LONG - 1) - LONG * changed - (LONG - 1))


def _grams(words: Column, k: int) -> Column:
    empty = F.array().cast("array<bigint>")
    return F.when(F.size(words) >= k, F.transform(
        F.sequence(F.lit(0), F.size(words) - k),
        lambda i: F.xxhash64(F.lit(k), *[F.get(words, i + j) for j in range(k)]))).otherwise(empty)


def template_positions(spark: SparkSession, phrases: dict[str, str], texts: dict[str, str]) -> DataFrame:
    """h, label, exact, t (position), n_grams, words: a row per k-gram of every template."""
    rows = [(label, True, text.split(), 0) for text, label in phrases.items()]
    rows += [(label, False, text.split(), least_votes(len(text.split()))) for label, text in texts.items()]
    if sum(len(r[2]) for r in rows) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates have more than {MAX_TEMPLATE_WORDS} words in all")
    short = [r[2] for r in rows if len(r[2]) < (SHORT if r[1] else LONG)]
    if short:
        raise ValueError(f"templates too short to vote: {short}")
    table = spark.createDataFrame(rows, "label string, exact boolean, words array<string>, least int")
    grams = F.when(F.col("exact"), _grams(F.col("words"), SHORT)).otherwise(_grams(F.col("words"), LONG))
    return table.withColumn("template", F.hash("label", "words")).select(
        "label", "exact", "template", "least", F.when(~F.col("exact"), F.col("words")).alias("template_words"),
        F.size(grams).alias("n_grams"), F.posexplode(grams).alias("t", "h"))


def votes(keyed: DataFrame, templates: DataFrame) -> DataFrame:
    """Hits summed by diagonal: doc, hash, the template and the template positions that voted."""
    words = keyed.select("doc", "hash", text_words(F.col("text")).alias("words"))
    grams = words.select("doc", "hash", F.size("words").alias("n"),
                         F.posexplode(F.concat(_grams(F.col("words"), SHORT), _grams(F.col("words"), LONG))).alias("i", "h"))
    hits = grams.join(F.broadcast(templates.select("h", "label", "exact", "template", "t", "n_grams")), "h")
    shorts = F.greatest(F.col("n") - (SHORT - 1), F.lit(0))
    place = F.when(F.col("exact"), F.col("i")).otherwise(F.col("i") - shorts)
    return hits.where(F.col("exact") == (F.col("i") < shorts)).groupBy(
        "doc", "hash", "template", "label", "exact", "n_grams", (place - F.col("t")).alias("diagonal")).agg(
        F.collect_set("t").alias("voted"))


def verified_spans(votes_: DataFrame, keyed: DataFrame, templates: DataFrame) -> DataFrame:
    """Spans of the longer templates: doc, hash, label, share."""
    by = W.partitionBy("doc", "hash", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by) > GAP
    near = (votes_.where(~F.col("exact")).withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int"))
            .withColumn("run", F.sum("apart").over(by)))
    runs = near.groupBy("doc", "hash", "template", "label", "run").agg(
        F.array_distinct(F.flatten(F.collect_list("voted"))).alias("voted"), F.collect_list("diagonal").alias("diagonals"))
    whole = templates.where(~F.col("exact")).select("template", "template_words", "least").distinct()
    runs = runs.join(F.broadcast(whole), "template").select(
        "*", F.array_min("diagonals").alias("from_d"), F.array_max("diagonals").alias("to_d"),
        F.array_min("voted").alias("from_t"), F.array_max("voted").alias("to_t"))
    then = W.partitionBy("doc", "hash", "template").orderBy("from_d")
    inserted = F.col("from_t") > F.lag("to_t").over(then)
    left_out = F.col("to_t") < F.lag("from_t").over(then)
    goes_on = (F.col("from_d") - F.lag("to_d").over(then) <= F.size("template_words")) & (inserted | left_out)
    spans = runs.withColumn("own", (~F.coalesce(goes_on, F.lit(False))).cast("int")).withColumn(
        "span", F.sum("own").over(then)).groupBy("doc", "hash", "template", "label", "template_words", "least", "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("voted")))).alias("n_voted"),
        F.flatten(F.collect_list("diagonals")).alias("diagonals")).where(F.col("n_voted") >= F.col("least"))
    spans = written(spans.drop("least", "n_voted"), "spans")
    same = F.col("doc").eqNullSafe(F.col("of_doc")) & (F.col("hash") == F.col("of_hash"))
    met = spans.join(_only(keyed, spans), same).withColumn("words", text_words(F.col("text")))
    found = F.filter(F.sequence(F.lit(0), F.size("template_words") - 1), lambda t: F.exists(
        "diagonals", lambda d: F.get("words", (d + t).cast("int")) == F.get("template_words", t)))
    return met.select("doc", "hash", "label", (F.size(found) / F.size("template_words")).alias("share"),
                      F.size("words"), F.size("diagonals")).select("doc", "hash", "label", "share")


def _only(keyed: DataFrame, spans: DataFrame) -> DataFrame:
    """The texts that spans were found in, once each, before they are cut into words."""
    of = spans.select(F.col("doc").alias("of_doc"), F.col("hash").alias("of_hash")).distinct()
    hashes = spans.select(F.col("hash").alias("of_hash")).distinct()
    if hashes.count() <= MAX_BROADCAST:
        keyed = keyed.join(F.broadcast(hashes), F.col("hash") == F.col("of_hash"), "left_semi")
    same = F.col("doc").eqNullSafe(F.col("of_doc")) & (F.col("hash") == F.col("of_hash"))
    return keyed.join(of, same).select("of_doc", "of_hash", "text").dropDuplicates(["of_doc", "of_hash"])


RESULT = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES,
                 texts: dict[str, str] = TEXTS) -> DataFrame:
    """``docs`` with n_words, the phrase places, all labels and the best verified share (score)."""
    rest = [c for c in docs.columns if c.lower() not in RESULT]
    body = F.col(quoted(text))
    aside = {f"_{i}": c for i, c in enumerate(rest)}
    keyed = docs.select(*[F.col(quoted(c)).alias(a) for a, c in aside.items()], F.col(quoted(doc_id)).alias("doc"),
                        F.xxhash64(body).alias("hash"), body.alias("text"))
    templates = template_positions(docs.sparkSession, phrases, texts)
    voted = written(votes(keyed, templates), "votes")  # two branches read it
    exact = voted.where(F.col("exact") & (F.size("voted") == F.col("n_grams"))).select(
        "doc", "hash", "label", F.lit(1.0).alias("share"), F.col("diagonal").cast("long").alias("place"))
    spans = verified_spans(voted, keyed, templates).select("*", F.lit(None).cast("long").alias("place"))
    good = F.col("place").isNotNull() | (F.col("share") >= LEAST_SHARE)
    found = exact.unionByName(spans).groupBy(F.col("doc").alias("of_doc"), F.col("hash").alias("of_hash")).agg(
        F.count("place").alias("n_base"), F.min("place").alias("first_word"), F.max("place").alias("last_word"),
        F.collect_set(F.when(F.col("place").isNotNull(), F.col("label"))).alias("base"),
        F.collect_set(F.when(good, F.col("label"))).alias("all"), F.max("share").alias("score"))
    joined = keyed.withColumn("n_words", F.size(text_words(F.col("text"))).cast("long")).drop("text").join(
        found, F.col("doc").eqNullSafe(F.col("of_doc")) & (F.col("hash") == F.col("of_hash")), "left")
    return joined.select(
        *[F.col(a).alias(c) for a, c in aside.items()], "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce(F.array_join(F.sort_array("base"), ","), F.lit("")).alias("base_labels"),
        F.coalesce(F.array_join(F.sort_array("all"), ","), F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return license_scan(docs).drop("text")


def _sql_list(table: dict[str, str]) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in table.items())


_LEAST = ", ".join(f"('{label}', '{passage}', {least_votes(len(passage.split()))})" for label, passage in TEXTS.items())
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents
), p AS (
  SELECT label, string_split(phrase, ' ') AS tw FROM (VALUES {_sql_list(PHRASES)}) AS v(phrase, label)
), x AS (
  SELECT label, string_split(passage, ' ') AS tw, least FROM (VALUES {_LEAST}) AS v(label, passage, least)
), i AS (
  SELECT doc_id, w, unnest(range(len(w))) AS i FROM d
), base AS (
  SELECT doc_id, label, i AS place FROM i JOIN p ON w[i + 1] = tw[1] AND w[i + 1:i + len(tw)] = tw
), tg AS (
  SELECT label, tw, least, unnest(range(len(tw) - {LONG - 1})) AS t FROM x
), hit AS (
  SELECT DISTINCT doc_id, label, len(tw) AS n, least, t, i - t AS diagonal
  FROM i JOIN tg ON w[i + 1] = tw[t + 1] AND w[i + 2] = tw[t + 2] AND w[i + 3] = tw[t + 3] AND w[i + 4] = tw[t + 4]
), apart AS (
  SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, label ORDER BY diagonal) > {GAP}, false) AS a FROM hit
), run AS (
  SELECT *, sum(a::INT) OVER (PARTITION BY doc_id, label ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS run FROM apart
), many AS (
  SELECT doc_id, label, n, run, min(diagonal) AS from_d, max(diagonal) AS to_d, min(t) AS from_t, max(t) AS to_t
  FROM run GROUP BY doc_id, label, n, run
), own AS (
  SELECT *, coalesce(from_d - lag(to_d) OVER o <= n AND (from_t > lag(to_t) OVER o OR to_t < lag(from_t) OVER o), false) AS goes_on
  FROM many WINDOW o AS (PARTITION BY doc_id, label ORDER BY from_d)
), part AS (
  SELECT doc_id, label, run, sum((NOT goes_on)::INT) OVER (PARTITION BY doc_id, label ORDER BY from_d ROWS UNBOUNDED PRECEDING) AS span
  FROM own
), span AS (
  SELECT run.doc_id, run.label, span, list(DISTINCT diagonal) AS ds
  FROM run JOIN part ON run.doc_id = part.doc_id AND run.label = part.label AND run.run = part.run
  GROUP BY run.doc_id, run.label, span, least HAVING count(DISTINCT t) >= least
), ver AS (
  SELECT span.doc_id, span.label, len(tw) AS n,
         len(list_filter(range(len(tw)), lambda t: len(list_filter(ds, lambda g: g + t >= 0 AND w[g + t + 1] = tw[t + 1])) > 0)) AS m
  FROM span JOIN x ON span.label = x.label JOIN d ON d.doc_id = span.doc_id
), f AS (
  SELECT doc_id, label, place, 1.0::DOUBLE AS share, true AS good FROM base
  UNION ALL SELECT doc_id, label, NULL, m::DOUBLE / n, m::DOUBLE / n >= {LEAST_SHARE} FROM ver
), g AS (
  SELECT doc_id, count(place) AS n_base, min(place) AS first_word, max(place) AS last_word, max(share) AS score,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (place IS NOT NULL) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (good) AS labels
  FROM f GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""
