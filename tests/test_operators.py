import datetime as dt

import pytest
from pyspark.sql import functions as F

from dimetl.operators import quality as Q
from dimetl.operators.joins import fk_orphans, lookup_one, natural_join
from dimetl.operators.surrogate import dense_ids
from dimetl.operators.upsert import first_per_key, insert_if_absent, pk_replace, upsert_last_wins

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def test_upsert_last_wins_total_order(spark):
    rows = [
        (1, "Ana", "free", T0, 2),
        (1, "Ann", "paid", T0, 1),  # same ts: event id breaks the tie
        (1, "Anne", "free", T0 + dt.timedelta(seconds=5), 3),
        (2, None, "free", T0, 4),
    ]
    df = spark.createDataFrame(rows, "user_id long, name string, level string, ts timestamp, eid long")
    out = {r["user_id"]: r for r in upsert_last_wins(df, ["user_id"], ["name"], ["level"], ["ts", "eid"]).collect()}
    assert out[1]["name"] == "Ann" and out[1]["level"] == "free"
    assert out[2]["name"] is None


def test_upsert_with_existing_keeps_first_values(spark):
    existing = spark.createDataFrame([(1, "Old", "free")], "user_id long, name string, level string")
    new = spark.createDataFrame([(1, "New", "paid", T0, 1), (3, "C", "free", T0, 2)],
                                "user_id long, name string, level string, ts timestamp, eid long")
    out = {r["user_id"]: r for r in upsert_last_wins(new, ["user_id"], ["name"], ["level"], ["ts", "eid"], existing).collect()}
    assert (out[1]["name"], out[1]["level"]) == ("Old", "paid")
    assert out[3]["name"] == "C"


def test_insert_if_absent_first_wins(spark):
    existing = spark.createDataFrame([("s1", "keep")], "song_id string, title string")
    new = spark.createDataFrame([("s1", "drop"), ("s2", "b"), ("s2", "a")], "song_id string, title string")
    out = {r["song_id"]: r["title"] for r in insert_if_absent(existing, new, ["song_id"], ["title"]).collect()}
    assert out == {"s1": "keep", "s2": "a"}


def test_insert_if_absent_empty_new(spark):
    existing = spark.createDataFrame([("s1", "keep")], "song_id string, title string")
    new = spark.createDataFrame([], "song_id string, title string")
    assert insert_if_absent(existing, new, ["song_id"], ["title"]).count() == 1


def test_pk_replace_last_write(spark):
    df = spark.createDataFrame([(1, 1, T0, "a"), (1, 1, T0 + dt.timedelta(1), "b"), (1, 2, T0, "c")],
                               "s long, i long, ts timestamp, v string")
    out = {(r["s"], r["i"]): r["v"] for r in pk_replace(df, ["s", "i"], ["ts"]).collect()}
    assert out == {(1, 1): "b", (1, 2): "c"}


def test_first_per_key_hot_key(spark):
    # one key holds most rows; partial aggregation keeps it map-side
    df = spark.range(20000).select((F.when(F.col("id") < 15000, 0).otherwise(F.col("id"))).alias("k"), F.col("id").alias("v"))
    out = first_per_key(df, ["k"], ["v"])
    assert out.where("k = 0").first()["v"] == 0
    assert out.count() == 5001


def test_lookup_one_never_fans_out(spark):
    plays = spark.createDataFrame([("t", "a", 1.0), ("t", "a", 2.0), ("x", "y", 1.0)], "song string, artist string, length double")
    songs = spark.createDataFrame([("t", "a", 1.000001, "s2"), ("t", "a", 1.0, "s1"), ("t", "a", 1.0, "s0")],
                                  "title string, artist_name string, duration double, song_id string")
    out = lookup_one(plays, songs, [("song", "title"), ("artist", "artist_name"), ("length", "duration")],
                     take=["song_id"], order_by=["song_id"], decimal_keys=["length"]).collect()
    assert len(out) == 3
    got = sorted((r["length"], r["song_id"] or "") for r in out)
    assert got == [(1.0, ""), (1.0, "s0"), (2.0, "")]


def test_natural_join_keeps_fan_out(spark):
    l = spark.createDataFrame([("t", "a")], "song string, artist string")
    r = spark.createDataFrame([("t", "a", "s1"), ("t", "a", "s2")], "title string, artist_name string, song_id string")
    assert natural_join(l, r, [("song", "title"), ("artist", "artist_name")]).count() == 2
    assert natural_join(l, r.limit(0), [("song", "title"), ("artist", "artist_name")], "left").count() == 1


def test_fk_orphans_null_passes(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "fk long")
    dim = spark.createDataFrame([(1,)], "k long")
    assert [r["fk"] for r in fk_orphans(fact, "fk", dim, "k").collect()] == [2]


def test_dense_ids(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7 % 5000).alias("k")).repartition(5)
    out = dense_ids(df, ["k"], "id").collect()
    assert sorted(r["id"] for r in out) == list(range(5000))
    assert all(r["id"] == r["k"] for r in out)


def test_dq_counts_and_gate(spark):
    full = spark.range(3)
    empty = spark.range(0)
    res = Q.dq_counts({"full": full, "empty": empty})
    got = {r["subject"]: (r["observed"], r["passed"]) for r in res.collect()}
    assert got == {"full": (3, True), "empty": (0, False)}
    with pytest.raises(Q.DataQualityError):
        Q.assert_passed(res)
    Q.assert_passed(Q.dq_counts({"full": full}))


def test_dq_expectations(spark):
    df = spark.range(4).agg(F.count(F.lit(1)).alias("v"))
    res = Q.dq_expectations([("four", df, 4), ("five", df, 5)]).collect()
    assert {r["subject"]: r["passed"] for r in res} == {"four": True, "five": False}


def test_argument_validation(spark):
    from dimetl.sinks.writers import write_parquet
    from dimetl.sources.staging import render_path

    with pytest.raises(ValueError):
        write_parquet(spark.range(1), "")
    with pytest.raises(ValueError):
        render_path("{year}/{month}", {"year": 2024, "month": ""})
    assert render_path("{year}/{month}/{week}", {"year": 2019, "month": 12, "week": 1}) == "2019/12/1"
