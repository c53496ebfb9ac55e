"""Song-play model queries (filters, joins, upserts, time functions, star schema)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimetl.functions.keys import md5_key, ts_text
from dimetl.functions.time import epoch_ms_to_ts, epoch_ms_to_ts_seconds, weekday
from dimetl.operators import quality as Q
from dimetl.operators.filters import (
    dedup_rows,
    dim_distinct,
    filter_not_null,
    filter_plays,
    preview,
    project,
)
from dimetl.operators.joins import as_of_join, fk_orphans, lookup_one, natural_join
from dimetl.operators.surrogate import dense_ids
from dimetl.operators.upsert import insert_if_absent, first_per_key, pk_replace
from dimetl.functions.text import rename_positional
from dimetl.plans import songplays as SP
from dimetl.sinks.catalog import temp_view_query
from dimetl.verify.adapters import a_events, a_play, a_song, table, with_views
from dimetl.verify.registry import register
from dimetl.verify.sqlfn import sql_first, sql_md5, sql_ts_text

# ----------------------------------------------------------------- helpers


def _songs_lookup(spark, d):
    songs = a_song(spark, d)
    return SP.song_lookup(SP.songs_table(songs), SP.artists_table(songs))


SQL_DIMS = (
    "songs AS (SELECT song_id, title, artist_id, year, duration FROM a_song WHERE song_id IS NOT NULL),\n"
    "artists AS " + sql_first(
        "(SELECT artist_id, artist_name AS name, artist_location AS location, artist_latitude AS latitude, "
        "artist_longitude AS longitude FROM a_song WHERE artist_id IS NOT NULL)",
        "artist_id", "name, location, latitude, longitude",
        "artist_id, name, location, latitude, longitude",
    ) + ",\n"
    "lk AS (SELECT s.song_id, s.title, s.artist_id, s.duration, a.name AS artist_name "
    "FROM songs s JOIN artists a ON s.artist_id = a.artist_id),\n"
    "red AS " + sql_first(
        "(SELECT title, artist_name, CAST(duration AS DECIMAL(18,5)) AS dkey, song_id, artist_id FROM lk)",
        "title, artist_name, dkey", "song_id, artist_id", "title, artist_name, dkey, song_id, artist_id",
    ) + "\n"
)

PLAY_TS = sql_ts_text("p.start_time")

SQL_FACT_TAIL = "p.start_time, p.user_id, p.level, {sid} AS song_id, {aid} AS artist_id, p.session_id, p.location, p.user_agent, CAST(year(p.start_time) AS INTEGER) AS year, CAST(month(p.start_time) AS INTEGER) AS month"

SQL_LOOKUP_FACT = (
    with_views("a_play", "a_song").rstrip() + ",\n" + SQL_DIMS
    + "SELECT " + sql_md5("p.session_id", PLAY_TS, "p.user_id", "p.item_in_session") + " AS songplay_id, "
    + SQL_FACT_TAIL.format(sid="r.song_id", aid="r.artist_id")
    + " FROM a_play p LEFT JOIN red r ON p.song = r.title AND p.artist = r.artist_name"
    " AND CAST(p.length AS DECIMAL(18,5)) = r.dkey WHERE p.page = 'NextSong'"
)


# ----------------------------------------------------------------- filters


@register(
    "filter_plays",
    with_views("a_events") + "SELECT event_id, user_id, start_time, level FROM a_events WHERE page = 'NextSong'",
)
def q_filter_plays(spark, d):
    return filter_plays(a_events(spark, d)).select("event_id", "user_id", "start_time", "level")


@register(
    "filter_not_null",
    "SELECT * FROM (" + SQL_LOOKUP_FACT + ") WHERE song_id IS NOT NULL",
)
def q_filter_not_null(spark, d):
    return filter_not_null(SP.songplays(a_play(spark, d), _songs_lookup(spark, d), "lookup"), "song_id")


@register(
    "project_subset",
    with_views("a_play") + "SELECT session_id, item_in_session, song, artist, length FROM a_play",
)
def q_project_subset(spark, d):
    return project(a_play(spark, d), ["session_id", "item_in_session", "song", "artist", "length"])


@register(
    "rename_positional",
    with_views("a_events") + "SELECT event_id AS id, user_id AS uid, page AS kind, level AS tier FROM a_events",
)
def q_rename_positional(spark, d):
    return rename_positional(a_events(spark, d).select("event_id", "user_id", "page", "level"), ["id", "uid", "kind", "tier"])


# ------------------------------------------------------------------- joins


@register(
    "join_inner_natural",
    with_views("a_play", "a_song")
    + "SELECT p.session_id, p.item_in_session, s.song_id, s.artist_id FROM a_play p "
    "JOIN a_song s ON p.song = s.title AND p.artist = s.artist_name",
)
def q_join_inner(spark, d):
    j = natural_join(a_play(spark, d), a_song(spark, d).select("title", "artist_name", "song_id", "artist_id"),
                     [("song", "title"), ("artist", "artist_name")], "inner")
    return j.select("session_id", "item_in_session", "song_id", "artist_id")


@register(
    "join_left_natural",
    with_views("a_play", "a_song")
    + "SELECT p.session_id, p.item_in_session, s.song_id, s.artist_id FROM a_play p "
    "LEFT JOIN a_song s ON p.song = s.title AND p.artist = s.artist_name "
    "AND CAST(p.length AS DECIMAL(18,5)) = CAST(s.duration AS DECIMAL(18,5))",
)
def q_join_left(spark, d):
    j = natural_join(a_play(spark, d), a_song(spark, d).select("title", "artist_name", "duration", "song_id", "artist_id"),
                     [("song", "title"), ("artist", "artist_name"), ("length", "duration")], "left",
                     decimal_keys=["length"], right_columns=["song_id", "artist_id"])
    return j.select("session_id", "item_in_session", "song_id", "artist_id")


@register(
    "join_lookup_one",
    with_views("a_play", "a_song").rstrip() + ",\n" + SQL_DIMS
    + "SELECT p.session_id, p.item_in_session, p.user_id, r.song_id, r.artist_id FROM a_play p "
    "LEFT JOIN red r ON p.song = r.title AND p.artist = r.artist_name AND CAST(p.length AS DECIMAL(18,5)) = r.dkey",
)
def q_join_lookup_one(spark, d):
    j = lookup_one(a_play(spark, d), _songs_lookup(spark, d), [("song", "title"), ("artist", "artist_name"), ("length", "duration")],
                   take=["song_id", "artist_id"], order_by=["song_id", "artist_id"], decimal_keys=["length"])
    return j.select("session_id", "item_in_session", "user_id", "song_id", "artist_id")


@register(
    "join_dim_dim",
    with_views("a_song").rstrip() + ",\n" + SQL_DIMS + "SELECT song_id, title, artist_id, artist_name, duration FROM lk",
)
def q_join_dim_dim(spark, d):
    return _songs_lookup(spark, d).select("song_id", "title", "artist_id", "artist_name", "duration")


@register(
    "fk_orphans",
    with_views("a_play", "a_events")
    + "SELECT p.session_id, p.item_in_session, p.user_id FROM a_play p WHERE p.user_id IS NOT NULL "
    "AND NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT user_id FROM a_events WHERE user_id IS NOT NULL) u WHERE u.user_id = p.user_id)",
)
def q_fk_orphans(spark, d):
    users = SP.users_table(a_events(spark, d), latest_level=False, plays_only=False)
    return fk_orphans(a_play(spark, d), "user_id", users, "user_id").select("session_id", "item_in_session", "user_id")


# ----------------------------------------------------------------- upserts


SQL_USERS_LATEST = (
    "plays AS (SELECT * FROM a_events WHERE page = 'NextSong' AND user_id IS NOT NULL),\n"
    "f AS " + sql_first("plays", "user_id", "start_time, event_id", "user_id, first_name, last_name, gender") + ",\n"
    "l AS " + sql_first("plays", "user_id", "start_time DESC, event_id DESC", "user_id, level") + "\n"
    "SELECT f.user_id, f.first_name, f.last_name, f.gender, l.level FROM f JOIN l ON f.user_id = l.user_id"
)


@register("upsert_last_level", with_views("a_events").rstrip() + ",\n" + SQL_USERS_LATEST)
def q_upsert_last_level(spark, d):
    return SP.users_table(a_events(spark, d), latest_level=True, plays_only=True)


SQL_ARTIST_ROWS = (
    "s AS (SELECT artist_id, artist_name AS name, artist_location AS location, artist_latitude AS latitude, "
    "artist_longitude AS longitude, year FROM a_song),\n"
)


@register(
    "insert_if_absent",
    with_views("a_song").rstrip() + ",\n" + SQL_ARTIST_ROWS
    + "ex AS " + sql_first("(SELECT * FROM s WHERE year <= 25)", "artist_id", "name, location, latitude, longitude",
                           "artist_id, name, location, latitude, longitude") + ",\n"
    + "nw AS " + sql_first("(SELECT * FROM s WHERE artist_id NOT IN (SELECT artist_id FROM ex))", "artist_id",
                           "name, location, latitude, longitude", "artist_id, name, location, latitude, longitude") + "\n"
    + "SELECT * FROM ex UNION ALL SELECT * FROM nw",
)
def q_insert_if_absent(spark, d):
    songs = a_song(spark, d)
    rows = songs.select("artist_id", F.col("artist_name").alias("name"), F.col("artist_location").alias("location"),
                        F.col("artist_latitude").alias("latitude"), F.col("artist_longitude").alias("longitude"), "year")
    order = ["name", "location", "latitude", "longitude"]
    existing = first_per_key(rows.where(F.col("year") <= 25).drop("year"), ["artist_id"], order)
    return insert_if_absent(existing, rows.drop("year"), ["artist_id"], order)


PK_COLS = ["session_id", "item_in_session", "start_time", "user_id", "song", "artist", "length", "level"]


@register(
    "pk_replace",
    with_views("a_play")
    + "SELECT " + ", ".join(PK_COLS) + " FROM " + sql_first(
        "(SELECT " + ", ".join(PK_COLS) + " FROM a_play)", "session_id, item_in_session",
        "start_time DESC, user_id DESC, song DESC, artist DESC, length DESC, level DESC"),
)
def q_pk_replace(spark, d):
    return pk_replace(a_play(spark, d).select(*PK_COLS), ["session_id", "item_in_session"], ["start_time"])


# ------------------------------------------------------------- aggregates


@register(
    "dim_distinct",
    with_views("a_events") + "SELECT DISTINCT user_id, first_name, last_name, gender, level FROM a_events WHERE page = 'NextSong'",
)
def q_dim_distinct(spark, d):
    return dim_distinct(filter_plays(a_events(spark, d)), ["user_id", "first_name", "last_name", "gender", "level"])


@register(
    "dedup_rows",
    with_views("a_play") + "SELECT DISTINCT session_id, user_id, level, location, user_agent FROM a_play",
)
def q_dedup_rows(spark, d):
    return dedup_rows(a_play(spark, d).select("session_id", "user_id", "level", "location", "user_agent"))


@register(
    "fact_distinct",
    with_views("a_play")
    + "SELECT DISTINCT start_time, user_id, level, song, artist, session_id, location, user_agent FROM a_play WHERE page = 'NextSong'",
)
def q_fact_distinct(spark, d):
    cols = ["start_time", "user_id", "level", "song", "artist", "session_id", "location", "user_agent"]
    return filter_plays(a_play(spark, d)).select(*cols).distinct()


@register(
    "dq_counts",
    with_views("a_play", "a_song", "a_events")
    + " UNION ALL ".join(
        f"SELECT 'row_count' AS check_name, '{n}' AS subject, count(*) AS observed, CAST(1 AS BIGINT) AS expected, count(*) >= 1 AS passed FROM {t}"
        for n, t in [("plays", "a_play"), ("songs", "a_song"), ("events", "a_events"), ("customer", "customer")]
    ),
)
def q_dq_counts(spark, d):
    from dimetl.verify.adapters import table

    return Q.dq_counts({"plays": a_play(spark, d), "songs": a_song(spark, d), "events": a_events(spark, d),
                        "customer": table(spark, d, "customer")})


EXPECTATIONS_SQL = [
    ("lineitem_negative_quantity", "SELECT count(*) FROM lineitem WHERE l_quantity < 0", 0),
    ("orders_without_customer", "SELECT count(*) FROM orders WHERE o_custkey IS NULL", 0),
    ("events_unknown_type", "SELECT count(*) FROM events WHERE event_type NOT IN ('view', 'click', 'purchase', 'signup', 'error')", 0),
    ("regions", "SELECT count(*) FROM region", 5),
]


@register(
    "dq_expectations",
    " UNION ALL ".join(
        f"SELECT 'expectation' AS check_name, '{n}' AS subject, CAST(v AS BIGINT) AS observed, CAST({e} AS BIGINT) AS expected, "
        f"v IS NOT DISTINCT FROM {e} AS passed FROM ({s.replace('count(*)', 'count(*) AS v', 1)})"
        for n, s, e in EXPECTATIONS_SQL
    ),
)
def q_dq_expectations(spark, d):
    from dimetl.verify.adapters import table

    li, od, ev, rg = (table(spark, d, t) for t in ("lineitem", "orders", "events", "region"))
    one = F.count(F.lit(1)).alias("v")
    return Q.dq_expectations([
        ("lineitem_negative_quantity", li.where(F.col("l_quantity") < 0).agg(one), 0),
        ("orders_without_customer", od.where(F.col("o_custkey").isNull()).agg(one), 0),
        ("events_unknown_type", ev.where(~F.col("event_type").isin("view", "click", "purchase", "signup", "error")).agg(one), 0),
        ("regions", rg.agg(one), 5),
    ])


# -------------------------------------------------------------- functions


@register(
    "epoch_to_ts",
    with_views("a_events")
    + "SELECT event_id, ts_ms, make_timestamp(ts_ms * 1000) AS ts_millis, make_timestamp((ts_ms // 1000) * 1000000) AS ts_seconds FROM a_events",
)
def q_epoch_to_ts(spark, d):
    e = a_events(spark, d)
    return e.select("event_id", "ts_ms", epoch_ms_to_ts("ts_ms").alias("ts_millis"), epoch_ms_to_ts_seconds("ts_ms").alias("ts_seconds"))


SQL_TIME = (
    "SELECT start_time, CAST(hour(start_time) AS INTEGER) AS hour, CAST(day(start_time) AS INTEGER) AS day, "
    "CAST(week(start_time) AS INTEGER) AS week, CAST(month(start_time) AS INTEGER) AS month, "
    "CAST(year(start_time) AS INTEGER) AS year, CAST(dayofweek(start_time) AS INTEGER) AS weekday "
    "FROM (SELECT DISTINCT start_time FROM a_play WHERE page = 'NextSong' AND start_time IS NOT NULL)"
)


@register("dim_time", with_views("a_play") + SQL_TIME)
def q_dim_time(spark, d):
    return SP.time_table(filter_plays(a_play(spark, d)))


@register(
    "weekday_variants",
    with_views("a_events")
    + "SELECT event_id, dayname(start_time) AS weekday_name, CAST(dayofweek(start_time) AS INTEGER) AS weekday_sunday0, "
    "CAST(dayofweek(start_time) + 1 AS INTEGER) AS weekday_sunday1 FROM a_events",
)
def q_weekday_variants(spark, d):
    e = a_events(spark, d)
    return e.select("event_id", weekday("start_time", "name").alias("weekday_name"),
                    weekday("start_time", "sunday0").alias("weekday_sunday0"),
                    weekday("start_time", "sunday1").alias("weekday_sunday1"))


@register(
    "md5_key",
    with_views("a_play")
    + "SELECT session_id, item_in_session, " + sql_md5("session_id", sql_ts_text("start_time")) + " AS session_time_key FROM a_play",
)
def q_md5_key(spark, d):
    p = a_play(spark, d)
    return p.select("session_id", "item_in_session", md5_key("session_id", ts_text("start_time")).alias("session_time_key"))


# ------------------------------------------------------------ star schema


@register("star_songplays_lookup", SQL_LOOKUP_FACT)
def q_star_lookup(spark, d):
    return SP.songplays(a_play(spark, d), _songs_lookup(spark, d), "lookup")


SQL_SONG_ROWS = (
    "lk AS (SELECT DISTINCT title, artist_name, duration, song_id, artist_id FROM a_song WHERE song_id IS NOT NULL)\n"
)


def _star_inner_sql() -> str:
    dims = (
        SQL_SONG_ROWS.rstrip() + ",\n"
        "pl AS (SELECT DISTINCT start_time, user_id, level, song, artist, session_id, location, user_agent FROM a_play WHERE page = 'NextSong'),\n"
        "j AS (SELECT DISTINCT p.*, l.song_id, l.artist_id FROM pl p JOIN lk l ON p.song = l.title AND p.artist = l.artist_name)\n"
    )
    return (
        with_views("a_play", "a_song").rstrip() + ",\n" + dims
        + "SELECT " + sql_md5("p.session_id", PLAY_TS, "p.user_id", "p.song_id", "p.artist_id") + " AS songplay_id, "
        + SQL_FACT_TAIL.format(sid="p.song_id", aid="p.artist_id") + " FROM j p"
    )


def _star_left_sql() -> str:
    return (
        with_views("a_play", "a_song").rstrip() + ",\n" + SQL_SONG_ROWS
        + "SELECT " + sql_md5("p.session_id", PLAY_TS, "p.user_id", "p.item_in_session", "l.song_id") + " AS songplay_id, "
        + SQL_FACT_TAIL.format(sid="l.song_id", aid="l.artist_id")
        + " FROM a_play p LEFT JOIN lk l ON p.song = l.title AND p.artist = l.artist_name"
        " AND CAST(p.length AS DECIMAL(18,5)) = CAST(l.duration AS DECIMAL(18,5)) WHERE p.page = 'NextSong'"
    )


def _song_rows(spark, d):
    """Song source rows (they carry the artist name); no artist-table join, so no artist fan-out."""
    return SP.song_rows(a_song(spark, d))


@register("star_songplays_inner", _star_inner_sql())
def q_star_inner(spark, d):
    return SP.songplays(a_play(spark, d), _song_rows(spark, d), "inner")


@register("star_songplays_left", _star_left_sql())
def q_star_left(spark, d):
    return SP.songplays(a_play(spark, d), _song_rows(spark, d), "left")


# -------------------------------------------------------- ids and previews


@register(
    "surrogate_dense",
    with_views("a_song") + "SELECT row_number() OVER (ORDER BY song_id) - 1 AS id, song_id, title FROM a_song",
)
def q_surrogate_dense(spark, d):
    return dense_ids(a_song(spark, d).select("song_id", "title"), ["song_id"], "id")


@register(
    "preview_limit",
    with_views("a_song", "a_events")
    + "SELECT * FROM (SELECT 'songs' AS table_name, song_id AS row_key FROM a_song ORDER BY song_id LIMIT 5) "
    "UNION ALL SELECT * FROM (SELECT 'events' AS table_name, CAST(event_id AS VARCHAR) AS row_key FROM a_events ORDER BY event_id LIMIT 5) "
    "UNION ALL SELECT * FROM (SELECT 'customer' AS table_name, c_name AS row_key FROM customer ORDER BY c_name LIMIT 5)",
)
def q_preview_limit(spark, d):
    from dimetl.verify.adapters import table

    songs = preview(a_song(spark, d), ["song_id"], 5).select(F.lit("songs").alias("table_name"), F.col("song_id").alias("row_key"))
    events = preview(a_events(spark, d), ["event_id"], 5).select(F.lit("events").alias("table_name"), F.col("event_id").cast("string").alias("row_key"))
    cust = preview(table(spark, d, "customer"), ["c_name"], 5).select(F.lit("customer").alias("table_name"), F.col("c_name").alias("row_key"))
    return songs.unionByName(events).unionByName(cust)


@register(
    "temp_view_query",
    with_views("a_play")
    + "SELECT user_id, count(*) AS n_plays, count(DISTINCT session_id) AS n_sessions FROM a_play WHERE page = 'NextSong' GROUP BY user_id",
)
def q_temp_view_query(spark, d):
    return temp_view_query(
        a_play(spark, d), "plays_log",
        "SELECT user_id, count(*) AS n_plays, count(DISTINCT session_id) AS n_sessions FROM plays_log WHERE page = 'NextSong' GROUP BY user_id",
    )


# ------------------------------------------- dimension rules of the models

PLAY_TIME = "CAST(hour(start_time) AS INTEGER) AS hour, CAST(day(start_time) AS INTEGER) AS day, CAST(week(start_time) AS INTEGER) AS week, CAST(month(start_time) AS INTEGER) AS month, CAST(year(start_time) AS INTEGER) AS year"


def _star(spark, d, model):
    return SP.star_schema(a_play(spark, d), a_song(spark, d), model)


@register(
    "star_users_warehouse",
    with_views("a_play") + "SELECT DISTINCT user_id, first_name, last_name, gender, level FROM a_play WHERE user_id IS NOT NULL",
)
def q_star_users_warehouse(spark, d):
    """Distinct user tuples of every page view."""
    return _star(spark, d, "warehouse")["users"]


@register(
    "star_time_warehouse",
    with_views("a_play") + f"SELECT start_time, {PLAY_TIME}, CAST(dayofweek(start_time) AS INTEGER) AS weekday FROM (SELECT DISTINCT start_time FROM a_play)",
)
def q_star_time_warehouse(spark, d):
    """Time rows of every event."""
    return _star(spark, d, "warehouse")["time"]


@register(
    "star_artists_lake",
    with_views("a_song")
    + "SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location, artist_latitude AS latitude, artist_longitude AS longitude, year "
    "FROM a_song WHERE artist_id IS NOT NULL",
)
def q_star_artists_lake(spark, d):
    """Distinct artist rows with the year of their songs."""
    return _star(spark, d, "lake")["artists"]


@register(
    "star_time_orchestrated",
    f"SELECT start_time, {PLAY_TIME}, CAST(dayofweek(start_time) AS INTEGER) AS weekday FROM ({_star_left_sql()})",
)
def q_star_time_orchestrated(spark, d):
    """One time row per fact row."""
    return _star(spark, d, "orchestrated")["time"]


# ------------------------------------------------------------------- as of


@register(
    "asof_join",
    "WITH versions AS (SELECT o_custkey, o_orderdate AS day, count(*) AS n_orders, max(o_totalprice) AS best FROM orders GROUP BY ALL), "
    "shipped AS (SELECT l_orderkey, l_linenumber, o_custkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey) "
    "SELECT s.l_orderkey, s.l_linenumber, s.l_shipdate, CASE WHEN v.day + INTERVAL 90 DAY >= s.l_shipdate THEN v.day END AS last_order_day, "
    "CASE WHEN v.day + INTERVAL 90 DAY >= s.l_shipdate THEN v.n_orders END AS n_orders, "
    "CASE WHEN v.day + INTERVAL 90 DAY >= s.l_shipdate THEN v.best END AS best "
    "FROM shipped s ASOF LEFT JOIN versions v ON s.o_custkey = v.o_custkey AND s.l_shipdate >= v.day",
)
def q_asof_join(spark, d):
    """Every shipment with its customer's last ordering day up to then, which counts for 90 days."""
    orders = table(spark, d, "orders")
    versions = (
        orders.groupBy("o_custkey", F.col("o_orderdate").alias("last_order_day"))
        .agg(F.count("*").alias("n_orders"), F.max("o_totalprice").alias("best"))
        .withColumn("until", F.col("last_order_day") + F.expr("INTERVAL 90 DAYS"))
    )
    shipped = table(spark, d, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    shipped = shipped.select("l_orderkey", "l_linenumber", "o_custkey", "l_shipdate")
    return as_of_join(
        shipped, versions.withColumn("day", F.col("last_order_day")), ["o_custkey"], "l_shipdate", "day", ["last_order_day", "n_orders", "best"], end="until", slice_by="year"
    ).drop("o_custkey")
