"""Sources, sinks, catalog, incremental loads and query-keyed tables.

Round-trip queries write data Spark derives from the driver tables under the
shared checkpoint folder (a fresh folder per call), then read it back with the
operator under test; the oracle is the plain SELECT of the same projection.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimetl.operators import quality as Q
from dimetl.operators.filters import filter_not_blank, lookup_session_item, lookup_song_users, lookup_user_session, slices
from dimetl.plans import event_tables as ET
from dimetl.plans import songplays as SP
from dimetl.schemas import CSV_TIMED_POSITIONS, LISTING_ATTRIBUTES, LOG_SCHEMA, SONG_SCHEMA
from dimetl.session import scratch_path, shuffles_released
from dimetl.sinks import catalog as C
from dimetl.sinks import writers as W
from dimetl.sources import files as S
from dimetl.sources import rejects as RJ
from dimetl.sources import staging as ST
from dimetl.streaming.incremental import backfill_slice, ingest_available_now, stream_upsert_available_now
from dimetl.verify.adapters import (
    a_events,
    a_listing,
    a_play,
    a_song,
    csv_event_frame,
    dealt,
    log_json_frame,
    play_log_json_frame,
    register_view,
    table,
    with_views,
)
from dimetl.verify.q_songs import SQL_LOOKUP_FACT, _songs_lookup
from dimetl.verify.registry import register
from dimetl.verify.sqlfn import sql_first

SONG_COLS = ", ".join(SONG_SCHEMA.names)
LOG_COLS = ", ".join(LOG_SCHEMA.names)

# ------------------------------------------------------------ file writers


def write_songs(spark, d, codec: str | None = None) -> str:
    """Song JSON files three directory levels deep (hash letter / year parity / fixed)."""
    root = scratch_path(spark, "song_data")
    s = a_song(spark, d).withColumns(
        {"l1": F.substring(F.md5("song_id"), 1, 1), "l2": (F.col("year") % 2).cast("string"), "l3": F.lit("A")}
    )
    s.repartition("l1", "l2").write.partitionBy("l1", "l2", "l3").json(root, compression=codec)
    return root


#: Events that one task sorts and writes.
EVENTS_PER_TASK = 250_000


def write_log(spark, d, split_by_level: bool = False):
    """Event log JSON files by year and month (``y=YYYY/m=M``)."""
    ev = a_events(spark, d)
    if not split_by_level:
        # A task sorts its rows by month before it writes them: they are dealt by their own values,
        # so that neither a full month nor a table in one file split makes a task large.
        ev = dealt(ev, table(spark, d, "events").count(), EVENTS_PER_TASK, "event_id", "user_id", "ts_ms", "value")
    log = log_json_frame(ev).withColumns(
        {"y": F.year(F.timestamp_millis("ts")), "m": F.month(F.timestamp_millis("ts"))}
    )
    if not split_by_level:
        root = scratch_path(spark, "log_data")
        log.write.partitionBy("y", "m").json(root)
        return root
    roots = []
    for lvl in ("paid", "free"):
        r = scratch_path(spark, f"log_{lvl}")
        log.where(F.col("level") == lvl).drop("y", "m").write.json(r)
        roots.append(r)
    return roots


#: Plays that are joined and shuffled at a time.
PLAYS_PER_SLICE = 40_000_000


def write_play_log(spark, d) -> str:
    """Play log JSON files, packed, by year and month (``y=YYYY/m=M``).

    Rows are written where the last join left them, sessions together, not shuffled
    once more; a slice of the orders at a time, whose shuffles are freed.
    """
    root = scratch_path(spark, "play_log")
    with shuffles_released(spark):
        for part in slices(table(spark, d, "lineitem").count(), PLAYS_PER_SLICE):
            log = play_log_json_frame(a_play(spark, d, part))
            log = log.withColumns({"y": F.year(F.timestamp_millis("ts")), "m": F.month(F.timestamp_millis("ts"))})
            log = log.sortWithinPartitions("y", "m", "sessionId", "itemInSession")
            log.write.mode("append").partitionBy("y", "m").option("compression", "gzip").json(root)
    return root


STAGING_EVENT_MAPPING = [
    ("artist", "$.artist"), ("auth", "$.auth"), ("first_name", "$.firstName"), ("gender", "$.gender"),
    ("item_in_session", "$.itemInSession"), ("last_name", "$.lastName"), ("length", "$.length"),
    ("level", "$.level"), ("location", "$.location"), ("method", "$.method"), ("page", "$.page"),
    ("registration", "$.registration"), ("session_id", "$.sessionId"), ("song", "$.song"),
    ("status", "$.status"), ("ts", "$.ts"), ("user_agent", "$.userAgent"), ("user_id", "$.userId"),
]

SQL_STAGING_EVENTS = (
    "SELECT artist, auth, firstName AS first_name, gender, itemInSession AS item_in_session, lastName AS last_name, "
    "length, level, location, method, page, registration, sessionId AS session_id, song, status, "
    "make_timestamp(ts * 1000) AS ts, userAgent AS user_agent, userId AS user_id FROM a_log_json"
)

# ------------------------------------------------------------------ scans


@register("scan_json_songs", with_views("a_song") + f"SELECT {SONG_COLS} FROM a_song")
def q_scan_json_songs(spark, d):
    return S.scan_json_songs(spark, write_songs(spark, d))


@register("scan_recursive", with_views("a_song") + f"SELECT {SONG_COLS} FROM a_song")
def q_scan_recursive(spark, d):
    return S.scan_recursive(spark, write_songs(spark, d), SONG_SCHEMA)


@register("scan_json_events", with_views("a_log_json") + f"SELECT {LOG_COLS} FROM a_log_json")
def q_scan_json_events(spark, d):
    return S.scan_json_events(spark, write_log(spark, d))


@register("copy_json_mapped", with_views("a_log_json") + SQL_STAGING_EVENTS)
def q_copy_json_mapped(spark, d):
    return S.copy_json_mapped(spark, f"{write_log(spark, d)}/*/*/*.json", STAGING_EVENT_MAPPING)


STAGING_SONGS = T.StructType(
    [T.StructField(n, SONG_SCHEMA[n].dataType) for n in ("title", "song_id", "artist_id", "year", "duration")]
)


@register("copy_json_auto", with_views("a_song") + "SELECT title, song_id, artist_id, year, duration FROM a_song")
def q_copy_json_auto(spark, d):
    return S.copy_json_auto(spark, f"{write_songs(spark, d)}/*/*/*/*.json", STAGING_SONGS)


CLEAN_LENGTHS = {"text": 256, "lang": 2, "source": 8}


@register(
    "copy_clean_flags",
    "SELECT doc_id, "
    + ", ".join(f"CASE WHEN trim({c}) = '' THEN NULL ELSE substring({c}, 1, {n}) END AS {c}" for c, n in CLEAN_LENGTHS.items())
    + ", n_chars FROM documents",
)
def q_copy_clean_flags(spark, d):
    return S.copy_clean(table(spark, d, "documents"), CLEAN_LENGTHS)


@register(
    "stage_source",
    with_views("a_log_json") + SQL_STAGING_EVENTS.replace(
        "FROM a_log_json", "FROM a_log_json WHERE year(make_timestamp(ts * 1000)) = 2024 AND month(make_timestamp(ts * 1000)) = 1"
    ),
)
def q_stage_source(spark, d):
    """Run-date templated staging key; the run date 2024-01-15 selects the January 2024 slice."""
    root = write_log(spark, d)
    ctx = ST.run_context(_dt.date(2024, 1, 15))
    raw = ST.stage_json(spark, root, "y={year}/m={month}/*.json", ctx, LOG_SCHEMA)
    return S.apply_json_paths(raw, STAGING_EVENT_MAPPING)


@register("stage_parquet", "SELECT * FROM orders")
def q_stage_parquet(spark, d):
    target = scratch_path(spark, "staging_orders")
    src = f"{d.rstrip('/')}/orders.parquet"
    ST.stage_parquet(spark, src, target)
    return ST.stage_parquet(spark, src, target)


SLICE_DAY = _dt.date(1997, 12, 30)


@register(
    "snapshot_slice",
    "SELECT o_orderkey, o_custkey, o_orderdate, CAST(isoyear(o_orderdate) AS INTEGER) AS snap_year, "
    "CAST(week(o_orderdate) AS INTEGER) AS snap_week FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-12-29' AND DATE '1998-01-04'",
)
def q_snapshot_slice(spark, d):
    """One week's slice of all orders; the week lies in two months and two years."""
    root = scratch_path(spark, "snapshots")
    ST.write_snapshots(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderdate", root)
    return ST.read_snapshot(spark, root, SLICE_DAY).select("o_orderkey", "o_custkey", "o_orderdate", "snap_year", "snap_week")


@register(
    "scan_json_subset",
    with_views("a_listing") + "SELECT " + ", ".join(LISTING_ATTRIBUTES) + " FROM a_listing",
)
def q_scan_json_subset(spark, d):
    root = scratch_path(spark, "listings")
    a_listing(spark, d).drop("c_custkey").write.json(root)
    return S.scan_json_subset(spark, root)


def write_csv(spark, d) -> str:
    root = scratch_path(spark, "event_csv")
    csv_event_frame(a_play(spark, d)).write.option("header", "true").option("compression", "gzip").csv(root)
    return root


CSV_KEPT = "artist, firstName, gender, itemInSession, lastName, length, level, location, sessionId, song, userId"


@register("scan_csv_events", with_views("a_csv") + f"SELECT {CSV_KEPT} FROM a_csv WHERE artist <> ''")
def q_scan_csv_events(spark, d):
    return S.scan_csv_events(spark, write_csv(spark, d))


@register("filter_blank", with_views("a_csv") + f"SELECT {CSV_KEPT} FROM a_csv WHERE song IS NOT NULL AND song <> ''")
def q_filter_blank(spark, d):
    return filter_not_blank(S.scan_csv_events(spark, write_csv(spark, d), drop_blank=None), "song")


TYPED = {"itemInSession": "int", "length": "double", "sessionId": "bigint", "userId": "bigint"}
TYPED_SQL = {"int": "INTEGER", "double": "DOUBLE", "bigint": "BIGINT"}


@register(
    "typed_cast",
    with_views("a_csv") + "SELECT " + ", ".join(
        f"TRY_CAST({c} AS {TYPED_SQL[TYPED[c]]}) AS {c}" if c in TYPED else c for c in CSV_KEPT.split(", ")
    ) + " FROM a_csv WHERE artist <> ''",
)
def q_typed_cast(spark, d):
    from dimetl.functions.text import typed_cast

    return typed_cast(S.scan_csv_events(spark, write_csv(spark, d)), TYPED)


@register("union_files", with_views("a_log_json") + f"SELECT {LOG_COLS} FROM a_log_json")
def q_union_files(spark, d):
    return S.union_files(spark, write_log(spark, d, split_by_level=True), LOG_SCHEMA)


@register(
    "ingest_counts",
    with_views("a_song") + "SELECT substr(md5(song_id), 1, 1) AS l1, count(*) AS n_rows FROM a_song GROUP BY 1",
)
def q_ingest_counts(spark, d):
    per_file = S.ingest_counts(S.scan_json_songs(spark, write_songs(spark, d)))
    return per_file.groupBy(F.regexp_extract("file", r"l1=([0-9a-f])", 1).alias("l1")).agg(
        F.sum("n_rows").cast("bigint").alias("n_rows")
    )


# ------------------------------------------------------------------ sinks


@register("sink_partitioned", SQL_LOOKUP_FACT)
def q_sink_partitioned(spark, d):
    """A full build over an older one: partitions that only the older build had are gone."""
    path = scratch_path(spark, "songplays")
    facts = SP.songplays(a_play(spark, d), _songs_lookup(spark, d), "lookup")
    W.write_partitioned(facts.withColumn("year", F.col("year") - 100), path, ["year", "month"])
    W.write_partitioned(facts, path, ["year", "month"])
    return spark.read.parquet(path)


@register("sink_parquet", "SELECT * FROM customer")
def q_sink_parquet(spark, d):
    path = scratch_path(spark, "customer")
    W.write_parquet(table(spark, d, "customer"), path)
    return spark.read.parquet(path)


FACT_COLS = ["session_id", "item_in_session", "user_id", "level", "song", "start_time"]


@register("load_fact_append", with_views("a_play") + "SELECT " + ", ".join(FACT_COLS) + " FROM a_play")
def q_load_fact_append(spark, d):
    path = scratch_path(spark, "fact_append")
    plays = a_play(spark, d).select(*FACT_COLS)
    W.append(plays.where(F.col("level") == "paid"), path)
    W.append(plays.where(F.col("level") != "paid"), path)
    return spark.read.parquet(path)


SQL_USERS_DISTINCT = "SELECT DISTINCT user_id, first_name, last_name, gender FROM a_events"


@register(
    "load_dim_modes",
    with_views("a_events") + f"SELECT * FROM ({SQL_USERS_DISTINCT}) UNION ALL SELECT * FROM ({SQL_USERS_DISTINCT})",
)
def q_load_dim_modes(spark, d):
    """Truncate-insert twice (one copy), then one append (two copies)."""
    path = scratch_path(spark, "dim_users")
    users = a_events(spark, d).select("user_id", "first_name", "last_name", "gender").distinct()
    W.load_dimension(users, path)
    W.load_dimension(users, path)
    W.load_dimension(users, path, append_rows=True)
    return spark.read.parquet(path)


@register(
    "sink_csv_quoted",
    with_views("a_song")
    + "SELECT '\"' || song_id || '\",\"' || title || '\",\"' || artist_name || '\",\"' || CAST(year AS VARCHAR) || '\"' AS line FROM a_song",
)
def q_sink_csv_quoted(spark, d):
    path = scratch_path(spark, "songs_csv")
    W.write_csv_quoted(a_song(spark, d).select("song_id", "title", "artist_name", "year"), path)
    header = '"song_id","title","artist_name","year"'
    return spark.read.text(path).where(F.col("value") != header).select(F.col("value").alias("line"))


JSON_SINK = T.StructType(
    [T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("page", T.StringType()),
     T.StructField("level", T.StringType()), T.StructField("value", T.DoubleType())]
)


@register("sink_json", with_views("a_events") + "SELECT event_id, user_id, page, level, value FROM a_events")
def q_sink_json(spark, d):
    path = scratch_path(spark, "events_json")
    W.write_json(a_events(spark, d).select(*JSON_SINK.names), path)
    return S.scan_json(spark, path, JSON_SINK)


USERS_TABLE = "presentation.users"


def _users_src(spark, d):
    return SP.users_table(a_events(spark, d), latest_level=True, plays_only=False)


SQL_USERS_ALL = (
    "plays AS (SELECT * FROM a_events WHERE user_id IS NOT NULL),\n"
    "f AS " + sql_first("plays", "user_id", "start_time, event_id", "user_id, first_name, last_name, gender") + ",\n"
    "l AS " + sql_first("plays", "user_id", "start_time DESC, event_id DESC", "user_id, level") + "\n"
)


@register(
    "ddl_roundtrip",
    with_views("a_events").rstrip() + ",\n" + SQL_USERS_ALL
    + "SELECT f.user_id, f.first_name, f.last_name, f.gender, l.level FROM f JOIN l ON f.user_id = l.user_id",
)
def q_ddl_roundtrip(spark, d):
    """Create, load, drop + recreate, reload: the table holds exactly one load."""
    root = scratch_path(spark, "warehouse")
    C.recreate_tables(spark, ["users"], root)
    users = _users_src(spark, d)
    users.write.insertInto(USERS_TABLE)
    C.recreate_tables(spark, ["users"], root)
    users.write.insertInto(USERS_TABLE)
    return spark.read.parquet(f"{root}/presentation.db/users")


@register(
    "insert_subset",
    with_views("a_events").rstrip() + ",\n" + SQL_USERS_ALL
    + "SELECT f.user_id, CAST(NULL AS VARCHAR) AS first_name, CAST(NULL AS VARCHAR) AS last_name, "
    "CAST(NULL AS VARCHAR) AS gender, l.level FROM f JOIN l ON f.user_id = l.user_id",
)
def q_insert_subset(spark, d):
    root = scratch_path(spark, "warehouse")
    C.recreate_tables(spark, ["users"], root)
    W.insert_subset(_users_src(spark, d), USERS_TABLE, ["user_id", "level"])
    return spark.read.parquet(f"{root}/presentation.db/users")


# ---------------------------------------------------------- incremental


@register("stream_available_now", with_views("a_log_json") + SQL_STAGING_EVENTS)
def q_stream_available_now(spark, d):
    """Two runs over the same folder: the second finds no new file and adds nothing."""
    src = scratch_path(spark, "stream_src")
    log_json_frame(a_events(spark, d)).repartition(4).write.json(src)
    target, ckpt = scratch_path(spark, "stream_out"), scratch_path(spark, "stream_ckpt")
    for _ in range(2):
        ingest_available_now(
            spark, src, LOG_SCHEMA, target, ckpt,
            transform=lambda b: S.apply_json_paths(b, STAGING_EVENT_MAPPING), max_files_per_trigger=1,
        )
    return spark.read.parquet(target).drop("source", "batch_id")


def _user_rows(batch):
    from dimetl.operators.filters import filter_not_null, filter_plays
    from dimetl.plans.jobs import normalise_log

    return filter_not_null(filter_plays(normalise_log(batch)), "user_id")


@register(
    "stream_upsert_users",
    with_views("a_events").rstrip() + ",\n"
    "plays AS (SELECT * FROM a_events WHERE page = 'NextSong' AND user_id IS NOT NULL),\n"
    "f AS " + sql_first("plays", "user_id", "ts_ms, event_id", "user_id, first_name, last_name, gender") + ",\n"
    "l AS " + sql_first("plays", "user_id", "ts_ms DESC, event_id DESC", "user_id, level") + "\n"
    "SELECT f.user_id, f.first_name, f.last_name, f.gender, l.level FROM f JOIN l ON f.user_id = l.user_id",
)
def q_stream_upsert_users(spark, d):
    """Users dimension kept by a file stream (one file per micro-batch, files in arbitrary time order)."""
    src = scratch_path(spark, "users_stream_src")
    log_json_frame(a_events(spark, d)).repartition(4).write.json(src)
    table = stream_upsert_available_now(
        spark, src, LOG_SCHEMA, scratch_path(spark, "users_dim"), scratch_path(spark, "users_ckpt"), _user_rows,
        ["user_id"], ["first_name", "last_name", "gender"], ["level"], ["start_time", "item_in_session"],
        max_files_per_trigger=1,
    )
    return table.read().select("user_id", "first_name", "last_name", "gender", "level")


@register("song_star_job", SQL_LOOKUP_FACT)
def q_song_star_job(spark, d):
    """The whole song-play load: raw song and play-log JSON folders -> five gated star tables."""
    from dimetl.plans.jobs import run_song_star

    paths = run_song_star(spark, write_songs(spark, d, "gzip"), write_play_log(spark, d), scratch_path(spark, "song_star"))
    return spark.read.parquet(paths["songplays"])


BACKFILL_COLS = ["session_id", "item_in_session", "level", "start_time"]


@register(
    "backfill_slice",
    with_views("a_play")
    + "SELECT session_id, item_in_session, CASE WHEN year(start_time) = 1998 AND month(start_time) = 6 THEN upper(level) ELSE level END AS level, "
    "start_time, CAST(year(start_time) AS INTEGER) AS year, CAST(month(start_time) AS INTEGER) AS month FROM a_play "
    "WHERE NOT (year(start_time) = 1998 AND month(start_time) = 7)",
)
def q_backfill_slice(spark, d):
    """Rewrite June 1998 with a corrected rule and July 1998, which has no rows any more; all other slices stay."""
    path = scratch_path(spark, "plays_by_month")
    t = a_play(spark, d).select(*BACKFILL_COLS).withColumns({"year": F.year("start_time"), "month": F.month("start_time")})
    W.write_partitioned(t, path, ["year", "month"])
    stored = spark.read.parquet(path)
    fixed = (
        a_play(spark, d).select(*BACKFILL_COLS)
        .withColumns({"year": F.year("start_time"), "month": F.month("start_time")})
        .where((F.col("year") == 1998) & (F.col("month") == 6))
        .withColumn("level", F.upper("level"))
        .select(*stored.columns)
    )
    backfill_slice(stored, fixed, path, ["year", "month"], [{"year": 1998, "month": 6}, {"year": 1998, "month": 7}])
    return spark.read.parquet(path)


# ------------------------------------------------------ query-keyed tables

register_view(
    "ev_rows",
    "ev_rows AS (SELECT TRY_CAST(sessionId AS BIGINT) AS session_id, TRY_CAST(itemInSession AS INTEGER) AS item_in_session, "
    "TRY_CAST(userId AS BIGINT) AS user_id, artist AS artist_name, song AS song_title, "
    "TRY_CAST(length AS DECIMAL(18,5)) AS song_length, firstName AS first_name, lastName AS last_name, TRY_CAST(ts AS BIGINT) AS ts "
    "FROM a_csv WHERE artist <> '')",
    ["a_csv"],
)


def _sql_event_table(name: str) -> str:
    pk, ck, rest = ET.EVENT_TABLES[name]
    cols = ", ".join(pk + ck + rest)
    order = ", ".join(f"{c} DESC" for c in ["ts", *rest])
    return f"SELECT {cols} FROM " + sql_first(f"(SELECT {cols}, ts FROM ev_rows)", ", ".join(pk + ck), order)


def _event_table(spark, d, name):
    return ET.event_table(ET.event_rows(S.scan_csv_events(spark, write_csv(spark, d), positions=CSV_TIMED_POSITIONS)), name)


def _stored_event_table(spark, d, name):
    """The table stored bucketed and sorted for its query, read from the catalog."""
    path = scratch_path(spark, name)
    saved = ET.save_event_table(_event_table(spark, d, name), name, path, 8, path.rsplit("/", 1)[-1].replace("-", "_"))
    return spark.table(saved)


@register("pk_replace_sessions", with_views("ev_rows") + _sql_event_table("music_sessions"), doubles=("song_length",))
def q_music_sessions(spark, d):
    return _event_table(spark, d, "music_sessions")


@register("clustered_layout", with_views("ev_rows") + _sql_event_table("music_users"))
def q_clustered_layout(spark, d):
    return ET.event_table_layout(_event_table(spark, d, "music_users"), "music_users")


@register(
    "range_layout",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS TIMESTAMP) AS l_shipdate, l_quantity FROM lineitem "
    "WHERE l_partkey <= (SELECT max(l_partkey) // 4 FROM lineitem) "
    "AND l_shipdate >= (SELECT max(l_shipdate) - INTERVAL 365 DAY FROM lineitem)",
)
def q_range_layout(spark, d):
    """The line items laid out by part and ship date, then a box of both read back through the file statistics."""
    rows = table(spark, d, "lineitem")
    path = scratch_path(spark, "range_layout")
    W.write_range_layout(rows, path, ["l_partkey", "l_shipdate"], files=16, point_columns=["l_orderkey"])
    stored = spark.read.schema(rows.schema).parquet(path)
    top = stored.agg(F.floor(F.max("l_partkey") / 4).alias("part"), F.max("l_shipdate").alias("day")).first()
    box = stored.where((F.col("l_partkey") <= top["part"]) & (F.col("l_shipdate") >= F.lit(top["day"] - _dt.timedelta(days=365))))
    return box.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity")


# The three lookups ask the stored tables; their keys are taken from the data.


@register(
    "lookup_session_item",
    with_views("ev_rows").rstrip() + f",\nt AS ({_sql_event_table('music_sessions')})\n"
    "SELECT artist_name, song_title, song_length FROM t "
    "WHERE (session_id, item_in_session) = (SELECT (session_id, item_in_session) FROM t ORDER BY session_id DESC, item_in_session DESC LIMIT 1)",
    doubles=("song_length",),
)
def q_lookup_session_item(spark, d):
    t = _stored_event_table(spark, d, "music_sessions")
    key = t.agg(F.max(F.struct("session_id", "item_in_session")).alias("k")).first()["k"]
    return lookup_session_item(t, key[0], key[1]).select("artist_name", "song_title", "song_length")


@register(
    "lookup_user_session",
    with_views("ev_rows").rstrip() + f",\nt AS ({_sql_event_table('music_users')})\n"
    "SELECT item_in_session, artist_name, song_title, first_name, last_name FROM t "
    "WHERE (user_id, session_id) = (SELECT (user_id, session_id) FROM t ORDER BY user_id DESC, session_id DESC LIMIT 1)",
)
def q_lookup_user_session(spark, d):
    t = _stored_event_table(spark, d, "music_users")
    key = t.agg(F.max(F.struct("user_id", "session_id")).alias("k")).first()["k"]
    return lookup_user_session(t, key[0], key[1]).select(
        "item_in_session", "artist_name", "song_title", "first_name", "last_name"
    )


@register(
    "lookup_song_users",
    with_views("ev_rows").rstrip() + f",\nt AS ({_sql_event_table('music_history')})\n"
    "SELECT DISTINCT song_title, user_id, first_name, last_name FROM t WHERE song_title = (SELECT min(song_title) FROM t)",
)
def q_lookup_song_users(spark, d):
    t = _stored_event_table(spark, d, "music_history")
    title = t.agg(F.min("song_title").alias("s")).first()["s"]
    return lookup_song_users(t, title).select("song_title", "user_id", "first_name", "last_name")


# ------------------------------------------------------------ DQ suite


SUITE_SQL = (
    "WITH sp AS (" + SQL_LOOKUP_FACT + "),\n"
    "c AS (SELECT 'row_count' AS check_name, 'songplays' AS subject, count(*) AS observed, CAST(1 AS BIGINT) AS expected, count(*) >= 1 AS passed FROM sp),\n"
    "o1 AS (SELECT 'fk_orphans' AS check_name, 'songplays.song_id' AS subject, count(*) AS observed, CAST(0 AS BIGINT) AS expected, count(*) = 0 AS passed "
    "FROM sp WHERE song_id IS NOT NULL AND song_id NOT IN (SELECT 'SO' || CAST(p_partkey AS VARCHAR) FROM part)),\n"
    "o2 AS (SELECT 'fk_orphans' AS check_name, 'songplays.artist_id' AS subject, count(*) AS observed, CAST(0 AS BIGINT) AS expected, count(*) = 0 AS passed "
    "FROM sp WHERE artist_id IS NOT NULL AND artist_id NOT IN (SELECT p_brand FROM part)),\n"
    "e AS (SELECT 'expectation' AS check_name, 'plays_without_song' AS subject, count(*) AS observed, CAST(0 AS BIGINT) AS expected, count(*) = 0 AS passed "
    "FROM sp WHERE song_id IS NULL)\n"
    "SELECT * FROM c UNION ALL SELECT * FROM o1 UNION ALL SELECT * FROM o2 UNION ALL SELECT * FROM e"
)


@register("dq_suite", SUITE_SQL)
def q_dq_suite(spark, d):
    """Gates of a load: counts taken with the write, all foreign keys in one pass over the stored fact."""
    songs_raw = a_song(spark, d)
    path = scratch_path(spark, "dq_fact")
    counted = W.write_parquet(
        SP.songplays(a_play(spark, d), _songs_lookup(spark, d), "lookup"), path,
        observe={"rows": F.count(F.lit(1)), "no_song": F.count_if(F.col("song_id").isNull())},
    )
    return Q.dq_suite(
        Q.dq_observed(spark, [("row_count", "songplays", counted["rows"], 1), ("expectation", "plays_without_song", counted["no_song"], 0)]),
        Q.dq_fk_orphans(spark.read.parquet(path), {"song_id": (SP.songs_table(songs_raw), "song_id"),
                                                   "artist_id": (SP.artists_table(songs_raw), "artist_id")}, "songplays"),
    )


# ------------------------------------------- rejected records, differing files

REJECT_SCHEMA = T.StructType().add("event_id", T.LongType()).add("user_id", T.LongType()).add("value", T.DoubleType()).add("page", T.StringType())


def _write_lines_with_faults(spark, d, fmt: str) -> str:
    """Event records as text: every 10th cut short (JSON) or a field short (CSV), every 7th with text in a number."""
    path = scratch_path(spark, f"faulty_{fmt}")
    ev = a_events(spark, d).select(F.col("item_in_session").cast("bigint").alias("event_id"), "user_id", "value", "page")
    wrong = F.col("event_id") % 7 == 3
    if fmt == "json":
        good = F.to_json(F.struct("event_id", "user_id", "value", "page"))
        line = F.when(wrong, F.to_json(F.struct("event_id", F.lit("none").alias("user_id"), "value", "page"))).otherwise(good)
        line = F.when(F.col("event_id") % 10 == 0, F.substring(good, F.lit(1), F.length(good) - 3)).otherwise(line)
    else:
        number = F.when(wrong, F.lit("none")).otherwise(F.col("user_id").cast("string"))
        line = F.concat_ws(",", F.col("event_id").cast("string"), number, F.col("value").cast("string"), F.concat(F.lit('"'), "page", F.lit('"')))
        line = F.when(F.col("event_id") % 10 == 0, F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string"))).otherwise(line)
    ev.select(line.alias("line")).write.text(path)
    return path


def _sql_rejects(short: str) -> str:
    return (
        with_views("a_events")
        + f"SELECT CAST(item_in_session AS BIGINT) AS event_id, CASE WHEN item_in_session % 10 = 0 THEN '{short}' "
        f"WHEN item_in_session % 7 = 3 THEN 'a value of another type' END AS reason, "
        "CASE WHEN item_in_session % 10 <> 0 AND item_in_session % 7 <> 3 THEN user_id END AS user_id FROM a_events"
    )


def _loaded_and_rejected(spark, d, fmt: str):
    target, rejects = scratch_path(spark, f"copied_{fmt}"), scratch_path(spark, f"rejects_{fmt}")
    path = _write_lines_with_faults(spark, d, fmt)
    options = {"header": "false"} if fmt == "csv" else {}
    counts = RJ.copy_with_rejects(spark, path, REJECT_SCHEMA, target, rejects, max_rejects=1 << 40, fmt=fmt, **options)
    good, bad = spark.read.parquet(target), spark.read.parquet(rejects)
    if (good.count(), bad.count()) != (counts.good, counts.rejected):
        raise AssertionError("the load's counts differ from its tables")
    own = F.regexp_extract(RJ.RECORD, r'^(?:\{"event_id":)?([0-9]+)', 1).cast("bigint")
    rejected = bad.select(own.alias("event_id"), "reason", F.lit(None).cast("bigint").alias("user_id"))
    return good.select("event_id", F.lit(None).cast("string").alias("reason"), "user_id").unionByName(rejected)


@register("copy_rejects_json", _sql_rejects("not a JSON object"))
def q_copy_rejects_json(spark, d):
    """A load of JSON lines with planted bad records: good rows, and every reject with its reason."""
    return _loaded_and_rejected(spark, d, "json")


@register("copy_rejects_csv", _sql_rejects("another number of fields"))
def q_copy_rejects_csv(spark, d):
    return _loaded_and_rejected(spark, d, "csv")


def _write_differing_files(spark, d) -> str:
    """Three file sets of one table: attributes come and go, one changes from whole numbers to decimals, one to text."""
    root = scratch_path(spark, "differing")
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    c.where(k % 3 == 0).select(k.alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("code")).write.json(f"{root}/a")
    c.where(k % 3 == 1).select(k.alias("id"), (k + 0.5).cast("double").alias("score"), F.concat(F.lit("N"), "c_nationkey").alias("code")).write.json(f"{root}/b")
    c.where(k % 3 == 2).select(k.alias("id"), F.col("c_name").alias("name"), k.alias("score"), (k % 2 == 0).alias("even")).write.json(f"{root}/c")
    return root


@register(
    "scan_merged",
    "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 <> 1 THEN c_name END AS name, "
    "CASE c_custkey % 3 WHEN 1 THEN c_custkey + 0.5::DOUBLE WHEN 2 THEN c_custkey::DOUBLE END AS score, "
    "CASE c_custkey % 3 WHEN 0 THEN CAST(c_nationkey AS VARCHAR) WHEN 1 THEN 'N' || CAST(c_nationkey AS VARCHAR) END AS code, "
    "CASE WHEN c_custkey % 3 = 2 THEN c_custkey % 2 = 0 END AS even FROM customer",
)
def q_scan_merged(spark, d):
    return RJ.scan_merged(spark, _write_differing_files(spark, d), recursiveFileLookup="true")


@register(
    "schema_report",
    "SELECT * FROM (VALUES ('a', 'code', 'BIGINT'), ('a', 'id', 'BIGINT'), ('a', 'name', 'STRING'), ('b', 'code', 'STRING'), ('b', 'id', 'BIGINT'), "
    "('b', 'score', 'DECIMAL'), ('c', 'even', 'BOOLEAN'), ('c', 'id', 'BIGINT'), ('c', 'name', 'STRING'), ('c', 'score', 'BIGINT')) v(folder, attribute, type) "
    "JOIN (SELECT ['a', 'b', 'c'][CAST(c_custkey % 3 + 1 AS INTEGER)] AS folder, count(*) AS n_records FROM customer GROUP BY 1) USING (folder)",
)
def q_schema_report(spark, d):
    report = RJ.schema_report(spark, _write_differing_files(spark, d), recursiveFileLookup="true")
    folder = F.regexp_extract("file", "/([abc])/[^/]*$", 1)
    return report.groupBy(folder.alias("folder"), "attribute", "type").agg(F.sum("n_records").alias("n_records"))


@register(
    "table_ordered_read",
    with_views("a_events").rstrip() + ",\n" + SQL_USERS_ALL
    + "SELECT 'first_name,last_name,gender,level' AS columns, f.user_id, concat_ws('|', f.first_name, f.last_name, f.gender, l.level) AS row_text "
    "FROM f JOIN l ON f.user_id = l.user_id",
)
def q_table_ordered_read(spark, d):
    """Columns of a stored table in table order, the id left out, whatever order the load's frame had."""
    C.recreate_tables(spark, ["users"], scratch_path(spark, "warehouse"))
    src = _users_src(spark, d)
    W.insert_subset(src.select(*reversed(src.columns)), USERS_TABLE)
    columns = C.insertion_columns(spark, USERS_TABLE, exclude=["user_id"])
    stored = spark.table(USERS_TABLE)
    return stored.select(F.lit(",".join(columns)).alias("columns"), "user_id", F.concat_ws("|", *columns).alias("row_text"))
