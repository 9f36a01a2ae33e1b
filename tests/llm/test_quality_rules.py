"""Quality rules against plain Python, line rules one by one, and awkward rows."""

import random
import re
from collections import Counter

import duckdb
import pyarrow as pa

from corpus_rows import AWKWARD, docs_of, folder  # noqa: F401
from strata.llm import quality_rules as q

PROSE = "The cat sat on the mat and looked at every bird that flew by. "


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_base_counts_match_plain_python(docs_of):
    rows = AWKWARD + [(20 + i, PROSE * i + "a b c d a b c\nx\nx\n\n#*|" * (i % 3)) for i in range(8)]
    got = q.quality_rules(docs_of(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(r.text), r.doc_id
        assert not (r.base_failed and r.kept)
        assert r["a.b"] == "z" and r.hash == "x"


def test_each_line_rule_takes_its_lines(docs_of):
    clean = "\n".join(" ".join(f"word{i}x{j}" for j in range(9)) + "." for i in range(20))
    bad = {
        "symbols": "buy### now$$$ this*** is%%% great&&& !!!",
        "shouting": "BUY!! THIS!! NOW!! OR!! NEVER!! AGAIN!! EVER!!",
        "separators": "Home | News | Sport | Weather | Culture",
        "navigation": "Home About Contact Login",
        "boilerplate": "Copyright 2020 Example Ltd. All rights reserved.",
        "long bar": " ".join(w.title() for w in q.NAVIGATION) + " " + "Home Search " * 20,
        "bar with other words": "Home alpha Search beta Menu",
        "long notice": "This website uses cookies so that it can give every visitor the best experience that is possible on it, "
                       "to count visits and to show the pages that fit. If you go on we take it that you accept cookies from us "
                       "and from our partners.",
        "dashes": "-" * 300, "dotted": ". . . . . . . . . . . .", "short marks": "-a=c?b-",
    }
    rows = [(i, f"{clean}\n{line}") for i, line in enumerate(bad.values())] + [(99, clean)]
    got = {r.doc_id: r for r in q.quality_rules(docs_of(rows)).collect()}
    for i in range(len(bad)):
        assert (got[i].n_bad_lines, got[i].cleaned_text, got[i].kept) == (1, clean, True), list(bad)[i]
    assert (got[99].n_bad_lines, got[99].cleaned_text, got[99].kept) == (0, clean, True)


def test_long_lines_of_prose_pass(docs_of):
    filler = " ".join(f"word{i}" for i in range(300))
    lines = [f"{filler} read more {filler}", f"Go home. {filler}", f"{filler}. We read more of it. {filler}",
             "She said: \"No!\" (He -- the cook -- said: \"Yes...\")", "home is where about half of them search and then go on"]
    got = q.quality_rules(docs_of([(i, line) for i, line in enumerate(lines)])).collect()
    assert [(r.doc_id, r.n_bad_lines) for r in got if r.n_bad_lines] == []


def test_sql_agrees_on_lines_of_every_length(spark, folder):
    rng = random.Random(5)
    parts = [*q.NAVIGATION, *q.BOILERPLATE, "word", "Straße", "-", "==", "!!", ".", "| a", "?", "Lorem Ipsum", "x" * 40]
    texts = ["\n".join(" ".join(rng.choices(parts, [1] * (len(parts) - 9) + [rng.choice((1, 30, 300, 900))] + [3] * 8, k=rng.randrange(1, 60)))
                       for _ in range(8)) for _ in range(120)]
    d = folder(documents=pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts}))
    names = q.query(spark, d).columns
    got = sorted(tuple(r) for r in q.query(spark, d).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    assert got == sorted(con.execute(f"SELECT {', '.join(names)} FROM ({q.ORACLE})").fetchall())
    assert 100 < sum(r[names.index("n_bad_lines")] for r in got) < 900


def test_document_that_loses_too_much_is_rejected(docs_of):
    junk = "\n".join(f"spam{i}### offer{i}$$$ deal{i}*** cash{i}%%%" for i in range(30))
    got = {r.doc_id: r for r in q.quality_rules(docs_of([(1, junk), (2, junk + "\n" + PROSE)])).collect()}
    assert not got[1].base_failed and not got[1].kept and not got[2].kept


def test_filter_on_the_verdict_keeps_the_same_rows_and_runs_no_python(docs_of):
    rows = [(i, (PROSE + f"number {i} ") * (1 + i % 4) + " ".join(f"w{i}x{j}" for j in range(60))) for i in range(40)]
    judged = q.quality_rules(docs_of(rows))
    assert judged.where("kept").count() == sum(r.kept for r in judged.collect())
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


def test_empty_table(docs_of, spark):
    assert q.quality_rules(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_stage_keeps_the_columns(spark):
    docs = spark.createDataFrame([(1, PROSE.replace("cat", f"c{1}") + " ".join(f"w{j}" for j in range(60)), "en", "s", 3)],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    out = q.stage(spark, docs, "")
    assert out.schema.names == docs.schema.names and out.dtypes == docs.dtypes and out.count() == 1


def test_whole_text_is_searched_once_not_for_every_line(docs_of):
    plan = q.quality_rules(docs_of([(1, PROSE)]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("»)") == plan.count("•)") == plan.count("·)") == 1
    judged = next(line for line in plan.splitlines() if "transform(lines" in line)
    assert "coalesce(text" not in judged
