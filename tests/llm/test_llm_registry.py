"""Registered training-data queries on the smallest driver tables, and the pipeline."""

import os

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from dimetl.llm import exact_dedup, queries, simhash

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_one_query_for_each_operator():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries()) and set(queries.ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_equals_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[key](spark, SF)
    want = con.execute(queries.ORACLES[key]).fetchall()
    names = [d[0] for d in con.description]
    assert set(names) == set(got.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(repr, want))


def test_pipeline_stages_do_their_part(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF).cache()
        assert docs.columns == documents.columns
        if name == "exact_dedup":
            best = {}
            for r in before.collect():
                best[r.text] = max(best.get(r.text, -1), r.doc_id)
            assert {r.doc_id for r in docs.collect()} == set(best.values())
        if name == "near_dedup":
            reps = {r.component_id for r in simhash.near_dedup(before).collect()}
            assert {r.doc_id for r in docs.collect()} == reps
        if name == "personal_data":
            assert docs.count() == before.count() and docs.filter("n_chars <> length(text)").count() == 0
            assert docs.filter(r"text rlike '[a-z0-9]+@[a-z0-9]+\\.[a-z]'").count() == 0
    pieces = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}
    assert exact_dedup.exact_dedup(docs).filter("not kept").count() == 0


def test_pipeline_on_an_empty_table(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
