"""The pipeline: every stage keeps the columns and works on what the one before kept; registered SQL agrees."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from strata.llm import registry
from strata.llm.common import written

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "labels")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.dtypes, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, before, SF), name)
        assert after.dtypes == columns, name
        assert {r.doc_id for r in after.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}
        assert 0.5 * before.count() < after.count() <= before.count(), name
        before = after
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {
        r.doc_id for r in before.select("doc_id").collect()}


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, name):
    got = registry.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({registry.ORACLES[name]})").fetchall()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=key) == sorted(want, key=key)


def test_entry_lists_every_operator():
    names = E.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
