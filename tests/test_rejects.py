"""Rejected records, files of differing attributes, counts taken with writes, the one-pass key check."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimetl.operators import quality as Q
from dimetl.sinks import writers as W
from dimetl.sources import rejects as R

SCHEMA = T.StructType().add("id", T.LongType()).add("name", T.StringType()).add("score", T.DoubleType())


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def test_json_records_are_loaded_or_rejected(spark, tmp_dir):
    src, target, rejects = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/bad"
    _write(src, "a.json", ['{"id": 1, "name": "x", "score": 1.5}', '{"id": 2}', '{"id": "two"}', "{broken", '{"id": 3, "name": null, "extra": [1]}'])
    _write(src, "b.json", ["[1, 2]", '{"id": 4, "score": "high"}', "", '{"id": 5, "score": 2}'])
    with pytest.raises(R.RejectLimitError):
        R.copy_with_rejects(spark, src, SCHEMA, target, rejects, max_rejects=3)
    assert not os.path.exists(target) and spark.read.parquet(rejects).count() == 4
    counts = R.copy_with_rejects(spark, src, SCHEMA, target, rejects, max_rejects=4)
    assert counts == R.LoadCounts(4, 4)
    assert sorted((r.id, r.name, r.score) for r in spark.read.parquet(target).collect()) == [(1, "x", 1.5), (2, None, None), (3, None, None), (5, None, 2.0)]
    got = {(os.path.basename(r.file), r.rejected_record, r.reason) for r in spark.read.parquet(rejects).collect()}
    assert got == {
        ("a.json", '{"id": "two"}', R.WRONG_TYPE), ("a.json", "{broken", R.NOT_JSON), ("b.json", "[1, 2]", R.NOT_JSON), ("b.json", '{"id": 4, "score": "high"}', R.WRONG_TYPE),
    }


def test_csv_records_are_loaded_or_rejected(spark, tmp_dir):
    _write(f"{tmp_dir}/in", "a.csv", ["id,name,score", '1,"x, y",1.5', "2,,", "three,z,1", "4,z", "5,z,1,2", '6,"a,b",c'])
    counts = R.copy_with_rejects(spark, f"{tmp_dir}/in", SCHEMA, f"{tmp_dir}/out", f"{tmp_dir}/bad", max_rejects=9, fmt="csv")
    assert counts == R.LoadCounts(2, 4)
    assert sorted((r.id, r.name) for r in spark.read.parquet(f"{tmp_dir}/out").collect()) == [(1, "x, y"), (2, None)]
    reasons = {r.rejected_record: r.reason for r in spark.read.parquet(f"{tmp_dir}/bad").collect()}
    assert reasons == {"three,z,1": R.WRONG_TYPE, "4,z": R.FIELD_COUNT, "5,z,1,2": R.FIELD_COUNT, '6,"a,b",c': R.WRONG_TYPE}
    with pytest.raises(ValueError):
        R.read_with_rejects(spark, f"{tmp_dir}/in", SCHEMA, fmt="text")


def test_empty_files_load_nothing(spark, tmp_dir):
    _write(f"{tmp_dir}/in", "a.json", [""])
    assert R.copy_with_rejects(spark, f"{tmp_dir}/in", SCHEMA, f"{tmp_dir}/out", f"{tmp_dir}/bad") == R.LoadCounts(0, 0)


def test_files_of_differing_attributes_are_one_table(spark, tmp_dir):
    _write(tmp_dir, "a.json", ['{"id": 1, "v": 1, "odd name": "a"}', '{"id": 2, "v": null, "t": [1, 2]}'])
    _write(tmp_dir, "b.json", ['{"id": 3, "v": 2.5, "t": "x", "b": true}', "no json"])
    report = {(os.path.basename(r.file), r.attribute, r.type, r.n_records) for r in R.schema_report(spark, tmp_dir).collect()}
    assert {("a.json", "id", "BIGINT", 2), ("a.json", "v", "VOID", 1), ("a.json", "t", "ARRAY", 1), ("b.json", "v", "DECIMAL", 1), ("b.json", "b", "BOOLEAN", 1)} <= report
    merged = R.scan_merged(spark, tmp_dir)
    assert merged.schema.simpleString() == "struct<b:boolean,id:bigint,odd name:string,t:string,v:double>"
    rows = sorted((r["id"], r["v"], r["t"], r["b"], r["odd name"]) for r in merged.where("id IS NOT NULL").collect())
    assert rows == [(1, 1.0, None, None, "a"), (2, None, "[1, 2]", None, None), (3, 2.5, "x", True, None)]


def test_counts_are_taken_with_the_write(spark, tmp_dir):
    df = spark.range(1000).withColumn("p", F.col("id") % 3)
    numbers = {"n": F.count(F.lit(1)), "odd": F.count_if(F.col("id") % 2 == 1)}
    assert W.write_parquet(df, tmp_dir + "/a", observe=numbers) == {"n": 1000, "odd": 500}
    assert W.write_partitioned(df, tmp_dir + "/b", ["p"], observe=numbers) == {"n": 1000, "odd": 500}
    assert W.write_parquet(df.limit(0), tmp_dir + "/c", observe=numbers) == {"n": 0, "odd": 0}
    assert W.write_parquet(df, tmp_dir + "/d") == {}
    rows = Q.dq_observed(spark, [("row_count", "a", 1000, 1), ("row_count", "c", 0, 1), ("expectation", "odd", 500, 0)]).collect()
    assert [(r.subject, r.observed, r.passed) for r in rows] == [("a", 1000, True), ("c", 0, False), ("odd", 500, False)]


def test_foreign_keys_are_checked_in_one_exchange(spark):
    fact = spark.createDataFrame([(1, "a", 1), (1, None, 2), (2, "z", None), (9, "z", 3), (None, None, None)] * 3, "u bigint, s string, t int")
    users, songs = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id bigint"), spark.createDataFrame([("a",)], "id string")
    times = spark.createDataFrame([], "id int")
    found = Q.dq_fk_orphans(fact, {"u": (users, "id"), "s": (songs, "id"), "t": (times, "id")}, "f")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "Join" not in plan
    assert [(r.subject, r.observed, r.passed) for r in found.collect()] == [("f.u", 3, False), ("f.s", 6, False), ("f.t", 9, False)]
    assert [r.passed for r in Q.dq_fk_orphans(fact.limit(0), {"u": (users, "id")}).collect()] == [True]
