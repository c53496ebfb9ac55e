"""Filters, projections, de-duplication, previews and layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLAY_PAGE = "NextSong"


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def filter_plays(df: DataFrame, page_col: str = "page") -> DataFrame:
    return filter_eq(df, page_col, PLAY_PAGE)


def filter_not_null(df: DataFrame, *columns: str) -> DataFrame:
    cond: Column | None = None
    for c in columns:
        term = F.col(c).isNotNull()
        cond = term if cond is None else cond & term
    return df.where(cond) if cond is not None else df


def filter_not_blank(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows with an empty-string (or NULL) attribute."""
    cond: Column | None = None
    for c in columns:
        term = F.col(c).isNotNull() & (F.col(c) != "")
        cond = term if cond is None else cond & term
    return df.where(cond) if cond is not None else df


def slice_of(df: DataFrame, columns: Sequence[str], part: tuple[int, int] = (0, 1)) -> DataFrame:
    """Slice ``i`` of ``n`` (``part``) by a hash of ``columns``: each row is in one slice, equal keys are in the same one."""
    i, n = part
    if not 0 <= i < n:
        raise ValueError(f"no slice {i} of {n}")
    return df if n == 1 else df.where(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(n)) == i)


def slices(rows: int, per_slice: int) -> list[tuple[int, int]]:
    """The slices (``slice_of``) that ``rows`` need at ``per_slice`` each, one at least."""
    n = max(1, -(-rows // per_slice))
    return [(i, n) for i in range(n)]


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {missing}")
    return df.select(*columns)


def const_columns(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.withColumns({k: (v if isinstance(v, Column) else F.lit(v)) for k, v in values.items()})


def dim_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``SELECT DISTINCT`` tuples (two-phase hash aggregate, combined map-side)."""
    return df.select(*columns).distinct()


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def preview(df: DataFrame, order_cols: Sequence[str], n: int = 5) -> DataFrame:
    """Deterministic ``LIMIT n``: top-n per partition, then merged (no full sort)."""
    return df.orderBy(*order_cols).limit(n)


def clustered(
    df: DataFrame, partition_cols: Sequence[str], clustering_cols: Sequence[str], num_partitions: int | None = None, spread: int = 1
) -> DataFrame:
    """Query-keyed layout: hash-distributed by partition key, sorted by clustering key.

    With ``spread`` over 1 each partition key is dealt over up to that many
    partitions by a hash of its clustering key (for hot keys).
    """
    parts = [F.col(c) for c in partition_cols]
    if spread > 1:
        parts.append(F.pmod(F.xxhash64(*clustering_cols), F.lit(spread)))
    out = df.repartition(num_partitions, *parts) if num_partitions else df.repartition(*parts)
    return out.sortWithinPartitions(*partition_cols, *clustering_cols)


def lookup_session_item(table: DataFrame, session_id: int, item_in_session: int) -> DataFrame:
    return table.where((F.col("session_id") == session_id) & (F.col("item_in_session") == item_in_session))


def lookup_user_session(table: DataFrame, user_id: int, session_id: int) -> DataFrame:
    return table.where((F.col("user_id") == user_id) & (F.col("session_id") == session_id)).orderBy("item_in_session")


def lookup_song_users(table: DataFrame, song_title: str) -> DataFrame:
    return table.where(F.col("song_title") == song_title).dropDuplicates(["song_title", "user_id"])
