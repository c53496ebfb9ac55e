"""Song-play star schema (fact ``songplays`` + ``users``, ``songs``, ``artists``, ``time``).

Input frames use snake_case names:

* plays log: ``start_time`` (timestamp), ``user_id``, ``first_name``,
  ``last_name``, ``gender``, ``level``, ``song``, ``artist``, ``length``,
  ``session_id``, ``item_in_session``, ``location``, ``user_agent``, ``page``;
* songs: ``song_id``, ``title``, ``artist_id``, ``artist_name``, ``duration``,
  ``year``, ``artist_location``, ``artist_latitude``, ``artist_longitude``.

Three fact variants (the models disagree, so the difference is a parameter):

``lookup``  at most one song per play on (title, artist name, duration); plays
            without a match kept with NULL ids;
``inner``   inner join on (title, artist name), fan-out kept, plays de-duplicated;
``left``    left join on (title, artist name, duration), fan-out kept.

The dimension rules that go with them are ``StarRules``; ``RULES`` has the four
models: ``relational``, ``warehouse``, ``lake`` and ``orchestrated``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimetl.functions.keys import md5_key, ts_text
from dimetl.functions.time import time_parts
from dimetl.operators.filters import dim_distinct, filter_not_null, filter_plays, slice_of
from dimetl.operators.joins import lookup_one, natural_join
from dimetl.operators.upsert import first_per_key, upsert_last_wins
from dimetl.sinks.writers import rebalanced

FACT_COLUMNS = [
    "songplay_id", "start_time", "user_id", "level", "song_id", "artist_id",
    "session_id", "location", "user_agent", "year", "month",
]
PLAY_ORDER = ["start_time", "session_id", "item_in_session"]


@dataclass(frozen=True)
class StarRules:
    """How one model builds its fact and dimensions."""

    variant: str
    latest_level: bool = False  # one row per user with the last level, or the distinct tuples
    users_from_plays: bool = True  # or from every event
    first_wins: bool = False  # songs and artists: first row per id, or the distinct rows
    artist_year: bool = False
    time_from: str = "plays"  # "plays", "events", or "fact" (one row per fact row)
    weekday: str = "sunday0"


RULES: dict[str, StarRules] = {
    "relational": StarRules("lookup", latest_level=True, first_wins=True, weekday="name"),
    "warehouse": StarRules("inner", users_from_plays=False, time_from="events"),
    "lake": StarRules("inner", artist_year=True, weekday="sunday1"),
    "orchestrated": StarRules("left", time_from="fact"),
}
#: Rules that a bare fact variant stands for.
_BY_VARIANT = {
    "lookup": StarRules("lookup", latest_level=True, first_wins=True),
    "inner": StarRules("inner"),
    "left": StarRules("left"),
}


def songs_table(songs: DataFrame, first_wins: bool = True) -> DataFrame:
    out = songs.select("song_id", "title", "artist_id", "year", "duration")
    out = filter_not_null(out, "song_id")
    return first_per_key(out, ["song_id"], ["title", "artist_id", "year", "duration"]) if first_wins else out.distinct()


def artists_table(songs: DataFrame, first_wins: bool = True, with_year: bool = False) -> DataFrame:
    year = ["year"] if with_year else []
    out = songs.select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
        *year,
    )
    out = filter_not_null(out, "artist_id")
    return first_per_key(out, ["artist_id"], ["name", "location", "latitude", "longitude", *year]) if first_wins else out.distinct()


def users_table(log: DataFrame, latest_level: bool = True, plays_only: bool = True, existing: DataFrame | None = None) -> DataFrame:
    """``latest_level``: one row per user, names from the first event, level from the last."""
    src = filter_plays(log) if plays_only else log
    src = filter_not_null(src, "user_id")
    if latest_level:
        return upsert_last_wins(
            src, ["user_id"], ["first_name", "last_name", "gender"], ["level"], ["start_time", "event_id"]
            if "event_id" in src.columns else PLAY_ORDER, existing
        )
    return dim_distinct(src, ["user_id", "first_name", "last_name", "gender", "level"])


def time_table(
    frame: DataFrame, weekday_convention: str = "sunday0", ts_col: str = "start_time", distinct: bool = True, deal: bool = False
) -> DataFrame:
    """``deal``: rows are dealt by year and month for a partitioned write, before their other parts are computed, and sorted."""
    rows = filter_not_null(frame.select(ts_col), ts_col)
    rows = rows.distinct() if distinct else rows
    if deal:
        rows = rebalanced(rows.select(ts_col, F.year(ts_col).alias("__y"), F.month(ts_col).alias("__m")), ["__y", "__m"])
    rows = rows.select(*time_parts(ts_col, weekday_convention))
    return rows.sortWithinPartitions("year", "month", ts_col) if deal else rows


def song_lookup(songs: DataFrame, artists: DataFrame | None = None) -> DataFrame:
    """Songs with their artist's name: songs ⋈ artists on ``artist_id`` when given."""
    if artists is None:
        return songs
    s = songs.select("song_id", "title", "artist_id", "duration")
    a = artists.select("artist_id", F.col("name").alias("artist_name"))
    return s.join(a, "artist_id", "inner")


def song_rows(songs_raw: DataFrame) -> DataFrame:
    """Distinct song source rows ``(title, artist_name, duration, song_id, artist_id)``."""
    return filter_not_null(
        songs_raw.select("title", "artist_name", "duration", "song_id", "artist_id"), "song_id"
    ).distinct()


def play_key(*cols) -> F.Column:
    return md5_key(*cols)


def songplays(plays_log: DataFrame, songs: DataFrame, variant: str = "lookup", deal: bool = False) -> DataFrame:
    """The fact table for one variant; ``songs`` carries ``title, artist_name, duration, song_id, artist_id``.

    ``deal``: rows are dealt by year and month for a partitioned write, before they get their keys, and sorted.
    """
    plays = filter_plays(plays_log)
    if variant == "lookup":
        j = lookup_one(
            plays, songs, [("song", "title"), ("artist", "artist_name"), ("length", "duration")],
            take=["song_id", "artist_id"], order_by=["song_id", "artist_id"], decimal_keys=["length"],
        )
        key = play_key("session_id", ts_text("start_time"), "user_id", "item_in_session")
    elif variant == "inner":
        cols = ["start_time", "user_id", "level", "song", "artist", "session_id", "location", "user_agent"]
        # Both inputs distinct on the columns kept => the join output is distinct
        # (no second de-dup shuffle over the fanned-out result).
        j = natural_join(
            plays.select(*cols).distinct(), songs.select("title", "artist_name", "song_id", "artist_id").distinct(),
            [("song", "title"), ("artist", "artist_name")], "inner",
        )
        key = play_key("session_id", ts_text("start_time"), "user_id", "song_id", "artist_id")
    elif variant == "left":
        j = natural_join(
            plays, songs.select("title", "artist_name", "duration", "song_id", "artist_id"),
            [("song", "title"), ("artist", "artist_name"), ("length", "duration")], "left",
            decimal_keys=["length"], right_columns=["song_id", "artist_id"],
        )
        key = play_key("session_id", ts_text("start_time"), "user_id", "item_in_session", "song_id")
    else:
        raise ValueError(f"unknown songplays variant {variant!r}")
    j = j.withColumns({"year": F.year("start_time"), "month": F.month("start_time")})
    if deal:
        # Only what the key and the table are made of: a key is as long as all the rest and does not compress.
        item = [c for c in ("item_in_session",) if c in j.columns]
        j = rebalanced(j.select(*FACT_COLUMNS[1:], *item), ["year", "month"]).sortWithinPartitions("year", "month", "start_time")
    return j.select(key.alias("songplay_id"), *FACT_COLUMNS[1:])


def star_rules(variant: str | StarRules) -> StarRules:
    """Rules of a name of ``RULES``, of a fact variant, or one's own."""
    rules = variant if isinstance(variant, StarRules) else {**_BY_VARIANT, **RULES}.get(variant)
    if rules is None:
        raise ValueError(f"unknown star variant {variant!r}")
    return rules


def fact_lookup(songs_raw: DataFrame, variant: str | StarRules = "lookup") -> DataFrame:
    """The songs that plays are matched with under one model."""
    rules = star_rules(variant)
    if rules.variant != "lookup":
        return song_rows(songs_raw)
    return song_lookup(songs_table(songs_raw, rules.first_wins), artists_table(songs_raw, rules.first_wins, rules.artist_year))


def star_schema(
    plays_log: DataFrame,
    songs_raw: DataFrame,
    variant: str | StarRules = "lookup",
    part: tuple[int, int] = (0, 1),
    lookup: DataFrame | None = None,
    deal: bool = False,
) -> dict[str, DataFrame]:
    """All five tables (lazy frames) of one model: a name of ``RULES``, a fact variant, or rules of one's own.

    ``part``: slice ``i`` of ``n`` of the tables that grow with the log (songplays,
    users, time); the slices of a table together are the table.  Each is cut by
    what its rows meet on, so a slice needs no row of another.  ``lookup`` is a
    stored ``fact_lookup``; ``deal`` as in ``songplays``.
    """
    rules = star_rules(variant)
    lookup = fact_lookup(songs_raw, rules) if lookup is None else lookup
    fact = songplays(slice_of(plays_log, ["song", "artist"], part), slice_of(lookup, ["title", "artist_name"], part), rules.variant, deal)
    if rules.time_from == "fact":
        times = fact
    else:
        times = slice_of(filter_plays(plays_log) if rules.time_from == "plays" else plays_log, ["start_time"], part)
    return {
        "songplays": fact,
        "users": users_table(slice_of(plays_log, ["user_id"], part), rules.latest_level, rules.users_from_plays),
        "songs": songs_table(songs_raw, rules.first_wins),
        "artists": artists_table(songs_raw, rules.first_wins, rules.artist_year),
        "time": time_table(times, rules.weekday, distinct=rules.time_from != "fact", deal=deal),
    }
