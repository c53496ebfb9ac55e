import datetime as dt
import json
import os
import random

import pytest

from dimetl.operators.upsert import merge_first_last, upsert_last_wins
from dimetl.streaming.incremental import stream_upsert_available_now
from dimetl.schemas import LOG_SCHEMA

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "user_id long, name string, level string, ts timestamp, eid long"


def _rows(n=60, seed=7):
    rnd = random.Random(seed)
    return [(rnd.randrange(5), f"n{i}", rnd.choice(["free", "paid"]), T0 + dt.timedelta(seconds=rnd.randrange(30)), i)
            for i in range(n)]


def _as_dict(df):
    return {r["user_id"]: (r["name"], r["level"]) for r in df.collect()}


def test_merge_is_order_and_batching_independent(spark):
    rows = _rows()
    whole = upsert_last_wins(spark.createDataFrame(rows, SCHEMA), ["user_id"], ["name"], ["level"], ["ts", "eid"])
    want = _as_dict(whole)
    for seed in (1, 2, 3):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        state = None
        for k in range(0, len(shuffled), 13):
            batch = spark.createDataFrame(shuffled[k:k + 13], SCHEMA)
            state = merge_first_last(state, batch, ["user_id"], ["name"], ["level"], ["ts", "eid"])
            state = spark.createDataFrame(state.collect(), state.schema)  # materialise like a stored version
        assert _as_dict(state) == want


def test_merge_replay_is_idempotent(spark):
    batch = spark.createDataFrame(_rows(20), SCHEMA)
    once = merge_first_last(None, batch, ["user_id"], ["name"], ["level"], ["ts", "eid"])
    twice = merge_first_last(once, batch, ["user_id"], ["name"], ["level"], ["ts", "eid"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def _log(i, user, level, ts_ms):
    return json.dumps({"page": "NextSong", "ts": ts_ms, "userId": str(user), "sessionId": 1, "itemInSession": i,
                       "firstName": f"f{i}", "lastName": "x", "gender": "F", "level": level})


def _prepare(batch):
    from dimetl.plans.jobs import normalise_log

    return normalise_log(batch)


def test_stream_upsert_restart(spark, tmp_dir):
    src, root, ckpt = tmp_dir + "/src", tmp_dir + "/dim", tmp_dir + "/ckpt"
    os.makedirs(src)
    # later events arrive in the first file
    with open(src + "/a.json", "w") as fh:
        fh.write(_log(2, 7, "paid", 2000) + "\n")
    with open(src + "/b.json", "w") as fh:
        fh.write(_log(1, 7, "free", 1000) + "\n")
    args = (LOG_SCHEMA, root, ckpt, _prepare, ["user_id"], ["first_name"], ["level"], ["start_time", "item_in_session"])
    t = stream_upsert_available_now(spark, src, *args, max_files_per_trigger=1)
    assert t.batches() == [0, 1]
    with pytest.raises(ValueError):
        stream_upsert_available_now(spark, src, *args, keep_batches=1)
    with pytest.raises(ValueError):  # a new checkpoint would start from nothing
        stream_upsert_available_now(spark, src, LOG_SCHEMA, root, ckpt + "2", *args[3:])
    r = t.read().collect()[0]
    assert (r["first_name"], r["level"]) == ("f1", "paid")
    stream_upsert_available_now(spark, src, *args, max_files_per_trigger=1)  # no new file: no new batch
    assert t.batches() == [0, 1]
    with open(src + "/c.json", "w") as fh:
        fh.write(_log(3, 7, "free", 3000) + "\n")
    stream_upsert_available_now(spark, src, *args, max_files_per_trigger=1)
    r = t.read().collect()[0]
    assert (r["first_name"], r["level"]) == ("f1", "free")


def test_stream_writes_changed_keys_only_and_folds(spark, tmp_dir):
    from dimetl.streaming.incremental import ROCKSDB, STATE_STORE, StreamedTable

    src, root, ckpt = tmp_dir + "/src", tmp_dir + "/dim", tmp_dir + "/ckpt"
    os.makedirs(src)
    provider = spark.conf.get(STATE_STORE)
    args = (LOG_SCHEMA, root, ckpt, _prepare, ["user_id"], ["first_name"], ["level"], ["start_time", "item_in_session"])
    days = [[(1, u, "free", 1000 + u) for u in range(20)] + [(1, None, "free", 5)], [(2, 3, "paid", 9000)], [(3, 4, "paid", 9000), (9, 99, "free", 1)]]
    want = {}
    for n, rows in enumerate(days):
        with open(f"{src}/{n}.json", "w") as fh:
            fh.write("\n".join(_log(i, u if u is not None else "", lv, ts) for i, u, lv, ts in rows) + "\n")
        t = stream_upsert_available_now(spark, src, *args)
        want |= {u: lv for _, u, lv, _ in rows}
        assert {r["user_id"]: r["level"] for r in t.read().collect()} == want
        assert spark.read.parquet(f"{root}/batch_id={n}").count() == len(rows)
    assert spark.conf.get(STATE_STORE) == provider != ROCKSDB
    assert os.path.isdir(f"{ckpt}/state")
    with pytest.raises(ValueError):
        t.fold(1)
    assert t.fold(2) == [0] and t.batches() == [1, 2]
    fresh = StreamedTable(spark, root, ["user_id"])
    assert {r["user_id"]: r["level"] for r in fresh.read().collect()} == want
    with pytest.raises(ValueError):
        StreamedTable(spark, tmp_dir + "/none", ["user_id"]).read()


def test_backfill_empties_named_slices_of_any_value(spark, tmp_dir):
    from dimetl.sinks.writers import write_partitioned
    from dimetl.streaming.incremental import backfill_slice

    rows = [(1, "a:b"), (2, None), (3, "x y/z"), (4, "k")]
    path = tmp_dir + "/slices"
    table = spark.createDataFrame(rows, "v int, s string")
    write_partitioned(table, path, ["s"])
    fixed = spark.createDataFrame([(40, "k")], "v int, s string")
    backfill_slice(spark.read.parquet(path), fixed, path, ["s"], [{"s": "a:b"}, {"s": None}, {"s": "k"}, {"s": "never there"}])
    assert sorted((r["v"], r["s"]) for r in spark.read.parquet(path).collect()) == [(3, "x y/z"), (40, "k")]


def test_second_source_and_lost_checkpoint(spark, tmp_dir):
    from dimetl.streaming.incremental import ingest_available_now

    target = tmp_dir + "/out"
    for name, ids in (("one", [1, 2]), ("two", [3])):
        os.makedirs(f"{tmp_dir}/{name}")
        with open(f"{tmp_dir}/{name}/a.json", "w") as fh:
            fh.write("\n".join(_log(i, i, "free", 1000) for i in ids) + "\n")
        ingest_available_now(spark, f"{tmp_dir}/{name}", LOG_SCHEMA, target, f"{tmp_dir}/ckpt-{name}")
    assert sorted(r["userId"] for r in spark.read.parquet(target).collect()) == ["1", "2", "3"]
    with pytest.raises(ValueError):
        ingest_available_now(spark, f"{tmp_dir}/one", LOG_SCHEMA, target, f"{tmp_dir}/ckpt-other")
