import json
import os

from pyspark.sql import functions as F

from dimetl.schemas import LISTING_ATTRIBUTES, LOG_SCHEMA
from dimetl.sinks import catalog as C
from dimetl.sinks import writers as W
from dimetl.sources import files as S
from dimetl.sources.staging import read_snapshot, snapshot_path, write_snapshots
from dimetl.streaming.incremental import ingest_available_now


def test_multiline_listing_array(spark, tmp_dir):
    doc = [
        {"ContractNumber": "C1", "Title": "T2 <b>flat</b>", "PriceCurrencyFormated": "250 000,00 €", "Extra": 1},
        {"ContractNumber": "C2", "Broker": "B"},
    ]
    with open(os.path.join(tmp_dir, "bot.json"), "w", encoding="utf-8") as fh:
        json.dump(doc, fh, indent=2)
    df = S.scan_json_subset(spark, tmp_dir, multi_line=True)
    assert df.columns == LISTING_ATTRIBUTES
    rows = sorted(df.collect(), key=lambda r: r["ContractNumber"])
    assert rows[0]["Broker"] is None and rows[1]["Broker"] == "B"


def test_csv_positions_and_blank_drop(spark, tmp_dir):
    header = "artist,auth,firstName,gender,itemInSession,lastName,length,level,location,method,page,registration,sessionId,song,status,ts,userId"
    lines = [header, "A,x,Ana,F,1,S,1.5,free,L,PUT,NextSong,1.0,9,Song,200,1,10", ",x,Bob,M,2,T,,free,L,GET,Home,1.0,9,,200,2,11"]
    with open(os.path.join(tmp_dir, "e.csv"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    df = S.scan_csv_events(spark, tmp_dir)
    assert len(df.columns) == 11 and df.count() == 1
    assert df.first()["userId"] == "10"


def test_partition_replacement(spark, tmp_dir):
    path = tmp_dir + "/t"
    df = spark.createDataFrame([(2023, 1, "a"), (2024, 1, "b")], "year int, month int, v string")
    W.write_partitioned(df, path, ["year", "month"])
    part = spark.createDataFrame([(2024, 1, "B")], "year int, month int, v string")
    W.write_partitioned(part, path, ["year", "month"], replace="slices")
    assert sorted((r["year"], r["v"]) for r in spark.read.parquet(path).collect()) == [(2023, "a"), (2024, "B")]
    W.write_partitioned(part, path, ["year", "month"])  # a full build leaves nothing of the older one
    assert sorted((r["year"], r["v"]) for r in spark.read.parquet(path).collect()) == [(2024, "B")]


def test_backfill_empties_a_slice_without_rows(spark, tmp_dir):
    from dimetl.streaming.incremental import backfill_slice

    path = tmp_dir + "/t"
    df = spark.createDataFrame([(2023, "a"), (2024, "b")], "year int, v string")
    W.write_partitioned(df, path, ["year"])
    stored = spark.read.parquet(path).select("year", "v")
    backfill_slice(stored, stored.where("year = 2024 AND v = 'none'"), path, ["year"], [{"year": 2024}])
    assert [r["v"] for r in spark.read.schema("v string, year int").parquet(path).collect()] == ["a"]


def test_recreated_tables_are_empty(spark, tmp_dir):
    users = spark.createDataFrame([(1, "Ana", "S", "F", "paid")], "user_id long, first_name string, last_name string, gender string, level string")
    for _ in range(2):
        C.recreate_tables(spark, ["users"], tmp_dir)
        assert spark.table("presentation.users").count() == 0
        users.write.insertInto("presentation.users")
    assert spark.table("presentation.users").count() == 1


def test_snapshot_slice_pruning(spark, tmp_dir):
    import datetime as dt

    df = spark.createDataFrame([(1, dt.date(2018, 12, 31)), (2, dt.date(2018, 12, 24))], "id int, d date")
    write_snapshots(df, "d", tmp_dir + "/s")
    assert snapshot_path(tmp_dir + "/s", dt.date(2018, 12, 31)).endswith("snap_year=2019/snap_week=1")
    got = read_snapshot(spark, tmp_dir + "/s", dt.date(2018, 12, 31))
    assert [r["id"] for r in got.collect()] == [1]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_insert_subset_and_ddl(spark, tmp_dir):
    C.recreate_tables(spark, ["users"], tmp_dir)
    src = spark.createDataFrame([(1, "Ana", "S", "F", "paid")], "user_id long, first_name string, last_name string, gender string, level string")
    W.insert_subset(src, "presentation.users", ["user_id", "level"])
    r = spark.read.parquet(tmp_dir + "/presentation.db/users").first()
    assert r["user_id"] == 1 and r["level"] == "paid" and r["first_name"] is None


def _log_line(i):
    return json.dumps({"page": "NextSong", "ts": 1541121934796 + i, "userId": str(i), "sessionId": i})


def test_stream_available_now_restart(spark, tmp_dir):
    src, out, ckpt = tmp_dir + "/src", tmp_dir + "/out", tmp_dir + "/ckpt"
    os.makedirs(src)
    for f in range(3):
        with open(f"{src}/f{f}.json", "w") as fh:
            fh.write("\n".join(_log_line(f * 10 + i) for i in range(5)) + "\n")
    ingest_available_now(spark, src, LOG_SCHEMA, out, ckpt, max_files_per_trigger=1)
    assert spark.read.parquet(out).count() == 15
    ingest_available_now(spark, src, LOG_SCHEMA, out, ckpt, max_files_per_trigger=1)  # nothing new
    assert spark.read.parquet(out).count() == 15
    with open(f"{src}/f9.json", "w") as fh:
        fh.write(_log_line(99) + "\n")
    ingest_available_now(spark, src, LOG_SCHEMA, out, ckpt, max_files_per_trigger=1)
    df = spark.read.parquet(out)
    assert df.count() == 16 and df.select("userId").distinct().count() == 16


def test_copy_json_paths(spark, tmp_dir):
    with open(tmp_dir + "/e.json", "w") as fh:
        fh.write(_log_line(1) + "\n")
    df = S.copy_json_mapped(spark, tmp_dir, [("user_id", "$.userId"), ("start_time", "$.ts")], epoch_ms_columns=("start_time",))
    r = df.first()
    assert r["user_id"] == "1" and r["start_time"].microsecond == 797000


def test_bucketed_tables_lookup_and_join(spark, tmp_dir):
    from dimetl.plans.event_tables import save_event_table
    from dimetl.operators.filters import lookup_session_item

    rows = spark.range(2000).select(
        (F.col("id") % 97).alias("session_id"), (F.col("id") % 13).cast("int").alias("item_in_session"),
        F.lit("a").alias("artist_name"), F.lit("s").alias("song_title"), F.lit(1.5).cast("decimal(18,5)").alias("song_length"),
    ).dropDuplicates(["session_id", "item_in_session"])
    t1 = save_event_table(rows, "music_sessions", tmp_dir + "/t1", 8, "ms_one")
    t2 = save_event_table(rows, "music_sessions", tmp_dir + "/t2", 8, "ms_two")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    # A filter alone does not make Spark keep the bucketed scan; point-lookup workloads turn that rule off.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        hit = lookup_session_item(spark.table(t1), 5, 5)
        assert hit.count() == 1
        assert "SelectedBucketsCount: 1 out of 8" in hit._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    a = spark.table(t1).select("session_id", F.col("item_in_session").alias("i1"))
    b = spark.table(t2).select("session_id", F.col("item_in_session").alias("i2"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = a.join(b, "session_id")
        want = rows.groupBy("session_id").count().select(F.sum(F.col("count") * F.col("count"))).first()[0]
        assert j.count() == want
        assert "Exchange" not in j._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql(f"DROP TABLE IF EXISTS {t1}")
    spark.sql(f"DROP TABLE IF EXISTS {t2}")


def test_insertion_columns(spark, tmp_dir):
    C.recreate_tables(spark, ["dim_broker"], tmp_dir)
    assert C.insertion_columns(spark, "presentation.dim_broker", ["broker_id"]) == [
        "broker", "hash", "record_start_date", "record_end_date"]


def _tables(spark, tmp_dir, customers: int = 0, events: int = 0) -> str:
    """Driver tables of one file each: customers with their nation, region and suppliers, and events of one month."""
    custkey = F.col("id").alias("c_custkey")
    frames = {
        "customer": spark.range(0, max(customers, 1), 1, 1).select(
            custkey, F.concat(F.lit("Customer#"), "id").alias("c_name"), F.lit(1).cast("int").alias("c_nationkey"), F.lit(12.5).alias("c_acctbal"), F.lit("AUTOMOBILE").alias("c_mktsegment")
        ),
        "nation": spark.sql("SELECT 1 AS n_nationkey, 'N' AS n_name, 0 AS n_regionkey"),
        "region": spark.sql("SELECT 0 AS r_regionkey, 'R' AS r_name"),
        "supplier": spark.range(0, 10, 1, 1).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("S"), "id").alias("s_name")),
        "events": spark.range(0, events, 1, 1).select(
            F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") + 1704100000).alias("ts"), (F.col("id") % 7).alias("user_id"),
            F.lit("click").alias("event_type"), F.lit(1.5).alias("value"), F.lit("{}").alias("props"),
        ),
    }
    for name, df in frames.items():
        df.coalesce(1).write.parquet(f"{tmp_dir}/{name}.parquet")
    return tmp_dir


def test_a_month_of_the_log_is_written_by_bounded_tasks(spark, tmp_dir, monkeypatch):
    from dimetl.verify import q_io

    monkeypatch.setattr(q_io, "EVENTS_PER_TASK", 500, raising=False)
    d = _tables(spark, tmp_dir, customers=5, events=4000)
    for query in (q_io.q_scan_json_events, q_io.q_copy_json_mapped):
        df = query(spark, d)
        per_file = [r["n_rows"] for r in S.ingest_counts(df).collect()]
        assert sum(per_file) == 4000 and len(per_file) == 8 and max(per_file) < 700


def test_pages_are_dealt_over_tasks(spark, tmp_dir):
    from dimetl.verify import adapters, q_pages

    d = _tables(spark, tmp_dir, customers=3 * adapters.CUSTOMERS_PER_TASK)
    for pages in (adapters.a_listing_page(spark, d), adapters.a_index_page(spark, d)):
        assert pages.rdd.getNumPartitions() == 3
    assert adapters.a_listing_page(spark, d).count() == 3 * adapters.CUSTOMERS_PER_TASK
    assert q_pages.q_index_links(spark, d).count() == 3 * adapters.CUSTOMERS_PER_TASK
