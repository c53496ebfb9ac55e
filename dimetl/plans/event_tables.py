"""Query-keyed event tables (one table per query, keyed for that query).

Each table keeps one row per primary key (the event with the latest ``ts`` wins,
then the other columns, as a wide-column store would keep the last write) and is laid out hash-distributed by its partition key and sorted
by its clustering key, so a lookup reads one partition of sorted rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimetl.operators.filters import clustered
from dimetl.operators.upsert import pk_replace

# Fixed value: table -> (partition key, clustering key, other columns).
EVENT_TABLES: dict[str, tuple[list[str], list[str], list[str]]] = {
    "music_sessions": (["session_id"], ["item_in_session"], ["artist_name", "song_title", "song_length"]),
    "music_users": (["user_id", "session_id"], ["item_in_session"], ["artist_name", "song_title", "first_name", "last_name"]),
    "music_history": (["song_title"], ["user_id"], ["first_name", "last_name"]),
}


def event_rows(events: DataFrame) -> DataFrame:
    """CSV event rows (text) -> typed attributes of the query tables, with ``ts`` (NULL where the export has none)."""
    ts = F.col("ts").try_cast("bigint") if "ts" in events.columns else F.lit(None).cast("bigint")
    return events.select(
        ts.alias("ts"),
        F.col("sessionId").try_cast("bigint").alias("session_id"),
        F.col("itemInSession").try_cast("int").alias("item_in_session"),
        F.col("userId").try_cast("bigint").alias("user_id"),
        F.col("artist").alias("artist_name"),
        F.col("song").alias("song_title"),
        F.col("length").try_cast("decimal(18,5)").alias("song_length"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
    )


def event_table(rows: DataFrame, name: str) -> DataFrame:
    pk, ck, rest = EVENT_TABLES[name]
    t = rows.select(*pk, *ck, "ts", *rest)
    return pk_replace(t, pk + ck, ["ts", *rest]).drop("ts")


def event_table_layout(table: DataFrame, name: str, num_partitions: int | None = None, spread: int = 1) -> DataFrame:
    """In-memory layout; ``spread`` splits a hot partition key over that many tasks by the clustering key."""
    pk, ck, _ = EVENT_TABLES[name]
    return clustered(table, pk, ck, num_partitions, spread)


def save_event_table(table: DataFrame, name: str, path: str, num_buckets: int, catalog_name: str | None = None) -> str:
    """Store a query-keyed table bucketed by its partition key and sorted by its clustering key.

    Every task writes its own file of a bucket, so a hot key is not gathered;
    a lookup by the partition key reads one bucket's files.
    """
    from dimetl.sinks.catalog import save_bucketed

    pk, ck, _ = EVENT_TABLES[name]
    qualified = catalog_name or name
    save_bucketed(table, qualified, path, pk, num_buckets, pk + ck)
    return qualified
