import datetime as dt

import pytest
from pyspark.sql import functions as F

from dimetl.functions.keys import row_hash
from dimetl.operators.scd2 import Scd2Table, duplicate_active_keys, overlapping_versions, scd2_apply, scd2_bulk, scd2_merge
from dimetl.schemas import OPEN_END_DATE

OPEN = dt.date.fromisoformat(OPEN_END_DATE)
D = ["2024-01-01", "2024-01-08", "2024-01-15"]


def staging(spark, rows):
    df = spark.createDataFrame(rows, "k string, v string")
    return df.withColumn("hash", row_hash("k", "v"))


def empty_target(spark, stg):
    return spark.createDataFrame([], "dim_id string, k string, v string, hash string, record_start_date date, record_end_date date")


def replay(spark, loads):
    t = None
    for d, rows in loads:
        s = staging(spark, rows)
        t = scd2_apply(t if t is not None else empty_target(spark, s), s, ["k"], d, "dim_id")
    return t


def check_invariants(df):
    rows = df.collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r["k"], []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r["record_start_date"])
        assert sum(1 for r in versions if r["record_end_date"] == OPEN) == 1
        for a, b in zip(versions, versions[1:]):
            assert a["record_end_date"] == b["record_start_date"] - dt.timedelta(days=1)  # no gap, no overlap
        for r in versions:
            assert r["record_end_date"] >= r["record_start_date"]


def test_three_loads(spark):
    loads = [
        (D[0], [("a", "1"), ("b", "1")]),
        (D[1], [("a", "2"), ("c", "1")]),  # a changes, b disappears (stays active), c new
        (D[2], [("a", "2"), ("b", "3"), ("c", "1")]),
    ]
    t = replay(spark, loads)
    check_invariants(t)
    got = sorted((r["k"], r["v"], str(r["record_start_date"]), str(r["record_end_date"])) for r in t.collect())
    assert got == [
        ("a", "1", D[0], "2024-01-07"),
        ("a", "2", D[1], OPEN_END_DATE),
        ("b", "1", D[0], "2024-01-14"),
        ("b", "3", D[2], OPEN_END_DATE),
        ("c", "1", D[1], OPEN_END_DATE),
    ]


def test_identical_reload_changes_nothing(spark):
    rows = [("a", "1"), ("b", "2")]
    once = replay(spark, [(D[0], rows)])
    twice = replay(spark, [(D[0], rows), (D[1], rows)])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_same_day_reload_replaces_version(spark):
    t = replay(spark, [(D[0], [("a", "1")]), (D[1], [("a", "2")]), (D[1], [("a", "3")])])
    check_invariants(t)
    assert sorted(r["v"] for r in t.collect()) == ["1", "3"]


def test_null_business_key_matches_itself(spark):
    t = replay(spark, [(D[0], [(None, "1")]), (D[1], [(None, "1")])])
    assert t.count() == 1


def test_duplicate_staging_rows_stop_the_load(spark, tmp_dir):
    twice = staging(spark, [("a", "1"), ("a", "2")])
    with pytest.raises(Exception, match="duplicate business key in staging: a"):
        replay(spark, [(D[0], [("a", "1"), ("a", "2")])]).collect()
    store = Scd2Table(spark, tmp_dir + "/dim", ["k"], "dim_id")
    with pytest.raises(Exception, match="duplicate business key"):
        store.load(twice, D[0])
    assert store.load_dates() == []


def test_duplicate_active_keys_are_found(spark):
    t = replay(spark, [(D[0], [("a", "1")])])
    assert duplicate_active_keys(t, ["k"]).count() == 0
    assert duplicate_active_keys(t.union(t), ["k"]).count() == 1


def test_bulk_equals_replay(spark):
    loads = [
        (D[0], [("a", "1"), ("b", "1")]),
        (D[1], [("a", "2"), ("c", "1")]),
        (D[2], [("a", "2"), ("b", "3"), ("c", "1")]),
    ]
    snaps = None
    for d, rows in loads:
        s = staging(spark, rows).withColumn("snapshot_date", F.lit(d).cast("date"))
        snaps = s if snaps is None else snaps.unionByName(s)
    bulk = scd2_bulk(snaps, ["k"], "snapshot_date", "dim_id")
    rep = replay(spark, loads)
    assert sorted(map(tuple, bulk.collect())) == sorted(map(tuple, rep.select(*bulk.columns).collect()))


def test_store_matches_in_plan_replay(spark, tmp_dir):
    loads = [
        (D[0], [("a", "1"), ("b", "1")]),
        (D[1], [("a", "2"), ("c", "1")]),
        (D[2], [("a", "2"), ("b", "3"), ("c", "1")]),
    ]
    store = Scd2Table(spark, tmp_dir + "/dim", ["k"], "dim_id")
    for d, rows in loads:
        store.load(staging(spark, rows), d)
    assert store.load_dates() == D
    fresh = Scd2Table(spark, tmp_dir + "/dim", ["k"], "dim_id")  # a new reader finds the loads
    stored = fresh.read()
    rep = replay(spark, loads)
    assert sorted(map(tuple, stored.select(*rep.columns).collect())) == sorted(map(tuple, rep.collect()))
    assert fresh.read_active().count() == 3


def test_merge_outputs(spark):
    s0 = staging(spark, [("a", "1")])
    t = scd2_apply(empty_target(spark, s0), s0, ["k"], D[0], "dim_id")
    active, closed = scd2_merge(t, staging(spark, [("a", "2")]), ["k"], D[1], "dim_id")
    assert [r["v"] for r in active.collect()] == ["2"]
    assert [str(r["record_end_date"]) for r in closed.collect()] == ["2024-01-07"]


def test_fold_keeps_content(spark, tmp_dir):
    loads = [
        (D[0], [("a", "1"), ("b", "1")]),
        (D[1], [("a", "2"), ("c", "1")]),
        (D[2], [("a", "2"), ("b", "3"), ("c", "1")]),
    ]
    store = Scd2Table(spark, tmp_dir + "/dim", ["k"], "dim_id")
    for d, rows in loads:
        store.load(staging(spark, rows), d)
    before = sorted(map(tuple, store.read().collect()))
    assert store.fold(keep=3) == [] and store.fold(keep=1) == D[:2]
    assert store.load_dates() == [D[2]]
    fresh = Scd2Table(spark, tmp_dir + "/dim", ["k"], "dim_id")
    assert sorted(map(tuple, fresh.read().collect())) == before
    store.load(staging(spark, [("a", "9")]), "2024-01-29")  # loads go on after a fold
    assert store.read().where("k = 'a' AND record_end_date = DATE'9999-12-31'").first()["v"] == "9"


def test_fold_cut_short_changes_nothing(spark, tmp_dir, monkeypatch):
    store = Scd2Table(spark, tmp_dir + "/dim", ["k"], "dim_id")
    for d, v in zip(D, "123"):
        store.load(staging(spark, [("a", v)]), d)
    before = sorted(map(tuple, store.read().collect()))
    monkeypatch.setattr("dimetl.operators.scd2.delete", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.fold()
    assert store.load_dates() == D and sorted(map(tuple, store.read().collect())) == before


def test_crashed_load_shows_no_rows(spark, tmp_dir):
    store = Scd2Table(spark, tmp_dir + "/dim", ["k"], "dim_id")
    store.load(staging(spark, [("a", "1")]), D[0])
    broken = staging(spark, [("a", "2"), ("c", "1")]).withColumn("v", F.when(F.col("k") == "c", F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        store.load(broken, D[1])
    fresh = Scd2Table(spark, tmp_dir + "/dim", ["k"], "dim_id")
    fresh.load(staging(spark, [("a", "1"), ("b", "1")]), D[1])
    assert sorted((r["k"], r["v"]) for r in fresh.read().collect()) == [("a", "1"), ("b", "1")]


def test_replaced_version_does_not_come_back(spark, tmp_dir):
    loads = [(D[0], [("a", "1"), ("b", "1")]), (D[0], [("a", "2")]), (D[1], [("a", "3")]), (D[1], [("a", "2"), ("c", "1")])]
    store = Scd2Table(spark, tmp_dir + "/dim", ["k"], "dim_id")
    for n, (d, rows) in enumerate(loads):
        store.load(staging(spark, rows), d)
        rep = replay(spark, loads[: n + 1])
        assert sorted(map(tuple, store.read().select(*rep.columns).collect())) == sorted(map(tuple, rep.collect()))
    got = sorted((r["k"], r["v"], str(r["record_start_date"]), str(r["record_end_date"])) for r in store.read().collect())
    assert got == [
        ("a", "2", D[0], "2024-01-07"), ("a", "2", D[1], OPEN_END_DATE), ("b", "1", D[0], OPEN_END_DATE), ("c", "1", D[1], OPEN_END_DATE),
    ]
    assert overlapping_versions(store.read(), ["k"]).count() == 0


def test_overlaps_in_the_history_are_found(spark):
    rows = [
        ("a", "2024-01-01", "2024-01-07"), ("a", "2024-01-07", "2024-01-20"), ("a", "2024-01-21", "9999-12-31"),
        ("b", "2024-01-01", "2024-01-07"), ("b", "2024-01-08", "9999-12-31"),
        (None, "2024-01-01", "2024-02-01"), (None, "2024-01-01", "2024-01-31"), ("c", "2024-02-01", "2024-01-01"),
    ]
    dim = spark.createDataFrame(rows, "k string, s string, e string").selectExpr("k", "DATE(s) AS record_start_date", "DATE(e) AS record_end_date")
    assert sorted((r["k"] or "", str(r["record_end_date"])) for r in overlapping_versions(dim, ["k"]).collect()) == [
        ("", "2024-01-31"), ("a", "2024-01-07"), ("c", "2024-01-01"),
    ]
    assert duplicate_active_keys(dim, ["k"]).count() == 0  # the gate of active keys does not see them


def test_empty_store(spark, tmp_dir):
    store = Scd2Table(spark, tmp_dir + "/dim", ["k"], "dim_id")
    with pytest.raises(ValueError):
        store.read()
    store.load(staging(spark, [("a", "1")]).limit(0), D[0])
    assert store.read().count() == 0 and store.load_dates() == []


def test_loads_come_in_date_order(spark, tmp_dir):
    store = Scd2Table(spark, tmp_dir + "/dim", ["k"], "dim_id")
    store.load(staging(spark, [("a", "1")]), D[1])
    with pytest.raises(ValueError):
        store.load(staging(spark, [("a", "2")]), D[0])
    store.load(staging(spark, [("a", "2")]), D[1])  # the same day replaces
    assert [(r["v"], str(r["record_start_date"])) for r in store.read().collect()] == [("2", D[1])]


def test_reader_and_second_writer_see_the_newest_version(spark, tmp_dir):
    one, two = (Scd2Table(spark, tmp_dir + "/dim", ["k"], "dim_id") for _ in range(2))
    one.load(staging(spark, [("a", "1")]), D[0])
    assert two.read().count() == 1
    two.load(staging(spark, [("a", "2")]), D[1])
    assert one.load_dates() == D[:2] and one.read().count() == 2
    one.load(staging(spark, [("a", "3")]), D[2])
    assert two.read_active().first()["v"] == "3" and two.read().count() == 3


def test_unchanged_rows_are_not_written_again(spark, tmp_dir):
    store = Scd2Table(spark, tmp_dir + "/dim", ["k"], "dim_id")
    store.load(staging(spark, [(f"k{n}", "1") for n in range(50)]), D[0])
    store.load(staging(spark, [(f"k{n}", "1" if n else "2") for n in range(50)]), D[1])
    assert spark.read.parquet(f"{tmp_dir}/dim/load_date={D[1]}").count() == 2
