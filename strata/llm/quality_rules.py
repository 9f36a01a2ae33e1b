"""Quality rules: line-first cleaning, then a verdict per document.

Every line of a text is judged on its own (punctuation, navigation and
boilerplate rules, all by shares of the line); failing lines are taken out; a document that loses more
than ``max_lost`` of its word characters, or that fails the base limits, is
rejected. Everything is one projection over built-in functions: no shuffle,
no Python, and a row's result depends on that row alone.

Defined results: a null text has no words and no lines, its cleaned text is
null; an empty text is kept as it is. Both fail the base limit on words.
Repeated rows get equal results, other columns pass through untouched, and an
input column with the name of a result column is replaced by the result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import quoted, settled

QUERY = "op1_quality_rules"

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
SEPARATOR = r"(?:^|[\x20\x09-\x0D])[|>»•·]"
PUNCTUATION = r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"
SENTENCE_END = "[.!?]"

# Words of navigation bars and phrases of page furniture.
NAVIGATION = (
    "home", "about", "contact", "login", "logout", "register", "menu", "search", "next", "previous",
    "back", "sitemap", "help", "faq", "shop", "cart", "checkout", "share", "subscribe", "archive",
)
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "use of cookies", "accept cookies", "uses cookies", "enable javascript", "click here", "read more",
    "sign up for our newsletter", "lorem ipsum", "powered by", "skip to content", "back to top",
)

# A line of over 40 % punctuation has two marks with at most one character between them, or is short.
_DENSE = rf"(?s){PUNCTUATION}.?{PUNCTUATION}|^.{{0,7}}$"
# A line of two words or more, 60 % of them of a bar, has two of those with at most one word between them.
_ANY_NAVIGATION = f"(?:{'|'.join(NAVIGATION)})"
_NAVIGATION_START = f"(?=[{''.join(sorted({w[0] for w in NAVIGATION}))}])(?<![a-z])"
_NAVIGATION_NEAR = f"{_NAVIGATION_START}{_ANY_NAVIGATION}[^a-z]+(?:[a-z]+[^a-z]+)?{_ANY_NAVIGATION}(?![a-z])"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the verdict."""

    min_words: int = 50             # fewer words fail the base limit
    max_repeat_percent: int = 50    # more words in repeated 3-word windows fail the base limit
    max_symbol_percent: int = 8     # punctuation: symbols per 100 characters of a line
    max_mark_percent: int = 40      # punctuation: ASCII punctuation marks per 100 characters of a line (40 or more)
    max_shout_marks: int = 5        # punctuation: "!!" marks in a line
    max_separators: int = 3         # navigation: "|", ">" or bullet separators between blanks
    nav_words_percent: int = 60     # navigation: of a line's two or more words so many percent (60 or more) fail it
    boilerplate_percent: int = 30   # boilerplate: sentences with a phrase make up so many percent of the line
    sentence_chars: int = 200       # ... where a longer sentence counts with so many characters
    max_lost_percent: int = 50      # a document that loses more word characters is rejected

    def __post_init__(self):
        if self.max_mark_percent < 40 or self.nav_words_percent < 60:
            raise ValueError("the tests before these two rules hold from 40 % punctuation and 60 % navigation words on")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _count(text: Column, pattern: str) -> Column:
    return F.size(F.split(text, pattern)) - 1


def line_fails(line: Column, has_symbols: Column, has_shout: Column, has_bar: Column, has_phrase: Column,
               rules: LineRules) -> Column:
    """True for a line that one of the three rule groups rejects; blank lines pass.

    Every rule is a share of the line, so lines of any length are judged alike.
    The flags say that the whole text holds a symbol or a separator, a "!!",
    navigation words side by side, or a boilerplate phrase; without them those
    rules cannot hold and are not evaluated per line.
    """
    punctuation = (
        (has_symbols & (_count(line, SYMBOLS) * 100 > F.length(line) * rules.max_symbol_percent))
        | (has_shout & (_count(line, "!!") > rules.max_shout_marks))
        | (line.rlike(_DENSE) & (_count(line, PUNCTUATION) * 100 > F.length(line) * rules.max_mark_percent))
    )
    separators = has_symbols & (_count(line, SEPARATOR) > rules.max_separators)
    bar = has_bar & F.lower(line).rlike(_NAVIGATION_NEAR) & F.exists(
        F.array(F.array_remove(F.split(F.lower(line), "[^a-z]+"), "")),
        lambda words: (F.size(words) >= 2) & (
            F.size(F.filter(words, lambda w: w.isin(*NAVIGATION))) * 100 >= F.size(words) * rules.nav_words_percent))
    sentences = F.filter(F.split(F.translate(line, _UPPER, _LOWER), SENTENCE_END), _phrase_in)
    covered = F.aggregate(sentences, F.lit(0), lambda n, x: n + F.least(F.length(x), F.lit(rules.sentence_chars)))
    phrase = has_phrase & _phrase_in(F.lower(line)) & F.exists(
        F.array(covered), lambda n: (n > 0) & (n * 100 >= F.length(line) * rules.boilerplate_percent))
    return punctuation | separators | bar | phrase


def _phrase_in(low: Column) -> Column:
    return reduce(or_, [F.contains(low, F.lit(p)) for p in BOILERPLATE])


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash of every 3-word window; windows are compared within one text only."""
    return F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))


def _repeat_words(hashes: Column) -> Column:
    """Number of words in windows found twice or more: sorting puts equal windows side by side."""
    windows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    places = F.flatten(F.flatten(F.transform(F.array(windows), lambda w: F.transform(
        F.filter(w, lambda x, i: (x["h"] == F.get(w, i - 1)["h"]) | (x["h"] == F.get(w, i + 1)["h"])),
        lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
        F.coalesce(F.size(F.array_distinct(places)), F.lit(0)))


RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bad_lines",
          "lost_chars", "base_failed", "kept", "cleaned_text")


def quality_rules(docs: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """``docs`` with the base counts, the cleaned text and the verdict.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    n_bad_lines, lost_chars (long), base_failed, kept (boolean) and
    cleaned_text (the lines that pass, joined again; the text itself when
    every line passes).
    """
    rest = [c for c in docs.columns if c.lower() not in RESULT]
    body = F.coalesce(F.col("text"), F.lit(""))
    step = docs.select(F.struct(*[F.col(quoted(c)) for c in rest]).alias("row"), F.col(quoted(text)).alias("text"))
    step = step.withColumns({"words": settled(_words(body)), "lines": settled(F.split(body, "\n")), "low": settled(F.lower(body))})
    step = step.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": _count(body, SYMBOLS).cast("long"),
        "worded": F.filter("lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "hashes": settled(_window_hashes(F.col("words"))),
        "has_shout": settled(F.contains(body, F.lit("!!"))),
        "has_bar": settled(F.col("low").rlike(_NAVIGATION_NEAR)),
        "has_phrase": settled(_phrase_in(F.col("low"))),
    })
    # settled like the other flags: a search of the whole text must not be repeated for every line
    step = step.withColumn("has_symbols", settled(
        (F.col("n_symbols") > 0) | F.contains(body, F.lit("»")) | F.contains(body, F.lit("•")) | F.contains(body, F.lit("·"))))
    step = step.withColumn("bad", settled(F.transform(
        "lines", lambda x: line_fails(
            x, F.col("has_symbols"), F.col("has_shout"), F.col("has_bar"), F.col("has_phrase"), rules))))
    step = step.withColumns({
        "n_dup_lines": (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long"),
        "n_lines": F.size("worded").cast("long"),
        "n_bad_lines": F.size(F.filter("bad", lambda x: x)).cast("long"),
        "n_repeat_words": _repeat_words(F.col("hashes")).cast("long"),
        "lost": F.filter("lines", lambda x, i: F.get("bad", i)),
    })
    step = step.withColumns({
        "lost_chars": F.length(F.regexp_replace(F.array_join("lost", ""), SPACE, "")).cast("long"),
        "base_failed": (F.col("n_words") < rules.min_words)
        | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent),
        "cleaned_text": F.when(F.col("n_bad_lines") == 0, F.col("text")).otherwise(
            F.array_join(F.filter("lines", lambda x, i: ~F.get("bad", i)), "\n")),
    })
    kept = ~F.col("base_failed") & (F.col("lost_chars") * 100 <= F.col("word_chars") * rules.max_lost_percent)
    return step.withColumn("kept", kept).select("row.*", *RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_rules(docs).drop("text", "cleaned_text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rejected documents go; kept ones carry their cleaned text."""
    columns = docs.columns
    done = quality_rules(docs).where("kept")
    return done.select(*[{
        "text": F.col("cleaned_text").alias("text"),
        "n_chars": F.length("cleaned_text").cast(docs.schema["n_chars"].dataType).alias("n_chars"),
    }.get(c, F.col(quoted(c))) for c in columns])


# The same rules in DuckDB.
_R = LineRules()


def _sql_words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{SPACE}'), lambda w: w <> '')"


_NAV_WORDS = "list_filter(regexp_split_to_array(lower(l), '[^a-z]+'), lambda w: w <> '')"
_COVERED = f"""list_sum(list_transform(list_filter(
      string_split_regex(translate(l, '{_UPPER}', '{_LOWER}'), '{SENTENCE_END}'), lambda x: regexp_matches(x, '{"|".join(BOILERPLATE)}')),
      lambda x: least(length(x), {_R.sentence_chars})))"""
_FAILS = f"""
      (len(string_split_regex(l, '{SYMBOLS}')) - 1) * 100 > length(l) * {_R.max_symbol_percent}
      OR len(regexp_extract_all(l, '{PUNCTUATION}')) * 100 > length(l) * {_R.max_mark_percent}
      OR len(string_split(l, '!!')) - 1 > {_R.max_shout_marks}
      OR len(regexp_extract_all(l, '{SEPARATOR}')) > {_R.max_separators}
      OR (len({_NAV_WORDS}) >= 2
          AND len(list_filter({_NAV_WORDS}, lambda w: w IN {NAVIGATION})) * 100 >= len({_NAV_WORDS}) * {_R.nav_words_percent})
      OR coalesce({_COVERED} * 100 >= length(l) * {_R.boilerplate_percent}, false)"""
ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), s AS (
  SELECT doc_id, t, {_sql_words('t')} AS w, string_split(t, chr(10)) AS ln FROM d
), r AS (
  SELECT doc_id, t, w, ln,
         list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g,
         list_filter(ln, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS worded,
         list_filter(ln, lambda l: {_FAILS}) AS bad
  FROM s
), k AS (
  SELECT doc_id, count(DISTINCT p + o) AS n FROM (
    SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, x) AS c
    FROM (SELECT doc_id, unnest(g) AS x, generate_subscripts(g, 1) AS p FROM r)
  ), (SELECT unnest([0, 1, 2]) AS o) WHERE c >= 2 GROUP BY doc_id
), f AS (
  SELECT r.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         len(string_split_regex(t, '{SYMBOLS}')) - 1 AS n_symbols,
         len(worded) - len(list_distinct(worded)) AS n_dup_lines, coalesce(k.n, 0) AS n_repeat_words,
         len(worded) AS n_lines, len(bad) AS n_bad_lines,
         length(regexp_replace(array_to_string(bad, ''), '[\x20\x09-\x0D]+', '', 'g')) AS lost_chars
  FROM r LEFT JOIN k ON r.doc_id = k.doc_id
), b AS (
  SELECT *, n_words < {_R.min_words} OR 100 * n_repeat_words > {_R.max_repeat_percent} * n_words AS base_failed FROM f
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(n_lines AS BIGINT) AS n_lines,
       CAST(n_bad_lines AS BIGINT) AS n_bad_lines, CAST(lost_chars AS BIGINT) AS lost_chars, base_failed,
       NOT base_failed AND lost_chars * 100 <= word_chars * {_R.max_lost_percent} AS kept
FROM b
"""
