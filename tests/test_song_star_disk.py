"""Disk of the song-play load: shuffle files are freed, tables are written in slices, rows are shuffled without what can be computed behind."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from dimetl.operators import quality as Q
from dimetl.operators.filters import slice_of, slices
from dimetl.operators.upsert import upsert_last_wins
from dimetl.plans import jobs
from dimetl.plans import songplays as SP
from dimetl.session import RELEASE, shuffles_released
from dimetl.sinks import writers as W

SF = "/root/testdata/sf0.001"


def _song(i, title, artist, year=2001, name=None):
    return {"num_songs": 1, "artist_id": artist, "artist_latitude": None, "artist_longitude": 1.0, "artist_location": "x",
            "artist_name": name or f"name of {artist}", "song_id": i, "title": title, "duration": 200.0, "year": year}


def _event(i, page="NextSong", song="Fado", artist="name of A1", user="10", month=0, length=200.0):
    return {"artist": artist, "auth": "Logged In", "firstName": f"first {i % 3}", "gender": "F", "itemInSession": i, "lastName": "Silva",
            "length": length, "level": "paid" if i % 2 else "free", "location": "Lisbon", "method": "PUT", "page": page, "registration": 1.0,
            "sessionId": 300 + i // 5, "song": song, "status": 200, "ts": 1541121934796 + i * 1000 + month * 2678400000, "userAgent": "test", "userId": user}


def _lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows) + "\n")


@pytest.fixture()
def raw(tmp_dir):
    songs = [_song("S1", "Fado", "A1"), _song("S2", "Fado", "A1"), _song("S1", "Other", "A1", 1999), _song("S3", "Fado", "A2", name="name of A1"),
             _song("S4", "Mar", "A3"), _song("S4", "Mar", "A3"), _song("S5", "Rio", "A1", 0)]
    events = [_event(i, song=["Fado", "Mar", "Rio", "unknown", None][i % 5], artist=["name of A1", "name of A3", None][i % 3],
                     user=[str(i % 7), None][i % 11 == 0], month=i % 4, page="Home" if i % 6 == 5 else "NextSong") for i in range(60)]
    _lines(f"{tmp_dir}/s/A/B/C/x.json", songs)
    _lines(f"{tmp_dir}/l/2018/11/e.json", events + events[:9])
    return tmp_dir


def _rows(spark, paths):
    return {n: sorted(map(repr, spark.read.parquet(p).select(*sorted(spark.read.parquet(p).columns)).collect())) for n, p in paths.items()}


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


@pytest.mark.parametrize("model", list(SP.RULES))
def test_slices_together_are_the_tables(spark, raw, monkeypatch, model):
    whole = _rows(spark, jobs.run_song_star(spark, f"{raw}/s", f"{raw}/l", f"{raw}/whole", model))
    assert len(whole["songplays"]) >= 20 and len(whole["time"]) >= 20
    monkeypatch.setattr(jobs, "EVENTS_PER_SLICE", 40)
    assert len(slices(69, 40)) == 2
    for _ in range(1 + (model == "relational")):  # a rerun replaces all slices
        assert _rows(spark, jobs.run_song_star(spark, f"{raw}/s", f"{raw}/l", f"{raw}/cut", model)) == whole


def test_load_leaves_no_shuffle_files(spark, raw):
    kept, setting = _shuffle_files(spark), spark.conf.get(RELEASE)
    jobs.run_song_star(spark, f"{raw}/s", f"{raw}/l", f"{raw}/out")
    assert not _shuffle_files(spark) - kept
    assert spark.conf.get(RELEASE) == setting


def test_setting_returns_after_an_error(spark):
    setting = spark.conf.get(RELEASE)
    with pytest.raises(ZeroDivisionError), shuffles_released(spark):
        assert spark.conf.get(RELEASE) == "true"
        1 / 0  # noqa: B018
    assert spark.conf.get(RELEASE) == setting


def test_play_log_in_slices_has_the_same_rows(spark, monkeypatch):
    from dimetl.schemas import LOG_SCHEMA
    from dimetl.sources import files as S
    from dimetl.verify import q_io
    from dimetl.verify.adapters import a_play, play_log_json_frame, table

    n = table(spark, SF, "lineitem").count()
    monkeypatch.setattr(q_io, "PLAYS_PER_SLICE", n // 3)
    kept = _shuffle_files(spark)
    read = S.scan_recursive(spark, q_io.write_play_log(spark, SF), LOG_SCHEMA)
    assert not _shuffle_files(spark) - kept
    wanted = play_log_json_frame(a_play(spark, SF)).select(*[F.col(f.name).cast(f.dataType) for f in LOG_SCHEMA])
    assert n > 0 and read.count() == n
    assert read.exceptAll(wanted).count() == 0 and wanted.exceptAll(read).count() == 0


def test_orders_meet_customers_as_lines_do(spark, tmp_dir):
    """Keys that are null, repeated or without a match give the same plays in either order of joins."""
    from dimetl.verify.adapters import a_play

    day = dt.date(1998, 6, 1)
    frames = {
        "lineitem": ([(o, p, i, day, f, "O") for i, (o, p, f) in enumerate([(1, 10, "R"), (1, 11, "N"), (2, 11, None), (2, None, "A"), (None, 11, "N"), (3, 10, "N"), (9, 10, "N")])],
                     "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_shipdate date, l_returnflag string, l_linestatus string"),
        "orders": ([(1, 5, "1-URGENT"), (1, 5, "1-URGENT"), (2, 6, "5-LOW"), (3, None, "2-HIGH"), (None, 5, "5-LOW")], "o_orderkey bigint, o_custkey bigint, o_orderpriority string"),
        "part": ([(10, "a b", "Brand#1", 1.5), (11, "c", "Brand#2", None), (11, None, "Brand#2", 2.5)], "p_partkey bigint, p_name string, p_brand string, p_retailprice double"),
        "customer": ([(5, "C5", "M", 1, 0.5), (5, "C5b", "M", 2, 0.5), (None, "C0", "M", 2, 0.5)], "c_custkey bigint, c_name string, c_mktsegment string, c_nationkey int, c_acctbal double"),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/{name}.parquet")
    wanted = sorted(map(repr, a_play(spark, tmp_dir).collect()))
    for n in (1, 3):
        got = [r for i in range(n) for r in a_play(spark, tmp_dir, (i, n)).collect()]
        assert len(wanted) > 8 and sorted(map(repr, got)) == wanted


def test_slice_of_keeps_every_row_once(spark):
    df = spark.createDataFrame([(None, None), (1, "a"), (1, "a"), (2, None), (None, "b")] * 3, "k int, v string")
    got = [r for i in range(4) for r in slice_of(df, ["k", "v"], (i, 4)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, df.collect()))
    assert slices(0, 5) == [(0, 1)] and slices(11, 5) == [(0, 3), (1, 3), (2, 3)]
    with pytest.raises(ValueError):
        slice_of(df, ["k"], (4, 4))


def test_play_keys_are_not_shuffled(spark, raw):
    """The rows dealt by year and month have no key yet; the job's write adds no other exchange."""
    jobs.run_song_star(spark, f"{raw}/s", f"{raw}/l", f"{raw}/out")
    log, songs = (spark.read.parquet(f"{raw}/out/staging/{n}") for n in ("events", "songs"))
    for model in SP.RULES:
        plan = SP.star_schema(log, songs, model, deal=True)["songplays"]._jdf.queryExecution().optimizedPlan().toString()
        above, below = plan.split("RebalancePartitions")
        assert "md5(" in above and "md5(" not in below


def test_append_needs_its_name(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2020)], "v int, year int")
    for _ in range(2):
        W.write_partitioned(df, f"{tmp_dir}/t", ["year"], replace="none", rebalance=False, codec="zstd")
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 2
    with pytest.raises(ValueError):
        W.write_partitioned(df, f"{tmp_dir}/t", ["year"], replace="some")


def test_foreign_keys_of_all_types(spark):
    t = [dt.datetime(2020, 1, 1, 0, 0, 0, 1), dt.datetime(2020, 1, 1, 0, 0, 0, 2), None]
    fact = spark.createDataFrame([(1, 1, "a", t[0], 1), (2, 2, "b", t[1], 2), (2, None, "1", t[2], 3), (None, 3, None, t[1], 4)], "a bigint, b int, c string, d timestamp, e int")
    dims = {
        "a": (spark.createDataFrame([(1,), (None,)], "k bigint"), "k"),
        "b": (spark.createDataFrame([(1,), (3,)], "k bigint"), "k"),
        "c": (spark.createDataFrame([("a",), ("b",)], "k string"), "k"),
        "d": (spark.createDataFrame([(t[0],)], "k timestamp"), "k"),
        "e": (spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "k string"), "k"),
    }
    got = {r["subject"]: (r["observed"], r["passed"]) for r in Q.dq_fk_orphans(fact, dims, "f").collect()}
    assert got == {"f.a": (2, False), "f.b": (1, False), "f.c": (1, False), "f.d": (2, False), "f.e": (0, True)}


def test_upsert_holds_the_order_once(spark):
    df = spark.createDataFrame([(1, 1, "x", "p"), (1, 2, None, "q"), (2, 5, None, None)], "k int, t int, a string, b string")
    got = upsert_last_wins(df, ["k"], ["a"], ["b"], ["t"])
    assert sorted(map(tuple, got.collect())) == [(1, "x", "q"), (2, None, None)]
    assert sorted(map(tuple, upsert_last_wins(df, ["k"], [], ["a", "b"], ["t"]).collect())) == [(1, None, "q"), (2, None, None)]
    assert sorted(map(tuple, upsert_last_wins(df, ["k"], [], [], ["t"]).collect())) == [(1,), (2,)]
    many = upsert_last_wins(df, ["k"], ["a", "b"], ["t"], ["t"])._jdf.queryExecution().optimizedPlan().toString()
    assert many.count("min_by(") == many.count("max_by(") == 1
