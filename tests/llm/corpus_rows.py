"""Rows that every operator must take, and the fixtures that make tables of rows."""

import os

import pyarrow.parquet as pq
import pytest

# null, empty, blank, long, repeated, and odd characters
AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one two three four"), (6, "same text here to see twice"),
    (6, "same text here to see twice"), (7, "same text here to see twice"), (None, "no id at all"), (None, None),
    (8, "word " * 30_000), (9, "é漢🙂 ▁ <|endoftext|> </s>"), (10, "a" * 20_000), (11, "line\n" * 500),
]


@pytest.fixture
def docs_of(spark):
    """A DataFrame of (doc_id, text) rows with clashing and awkward extra columns."""
    def make(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        if extra:
            df = df.selectExpr("*", "'x' AS hash", "1 AS n", "true AS kept", "'y' AS words", "2.5 AS score",
                               "'z' AS `a.b`", "7 AS n_words", "8 AS spans", "9 AS severity")
        return df
    return make


@pytest.fixture
def folder(tmp_path):
    """A folder with tables, given as name=pyarrow table."""
    def make(**tables):
        for name, table in tables.items():
            pq.write_table(table, os.path.join(tmp_path, f"{name}.parquet"))
        return str(tmp_path)
    return make
