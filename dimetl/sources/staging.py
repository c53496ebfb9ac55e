"""Staging loads and snapshot (time-slice) paths."""

from __future__ import annotations

import datetime as _dt
import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimetl.functions.time import iso_week, iso_year
from dimetl.sinks.writers import write_partitioned
from dimetl.sources.files import scan_json

#: A week is one slice: ISO year and ISO week, whatever months it touches.
SNAPSHOT_COLUMNS = ("snap_year", "snap_week")


def render_path(template: str, context: Mapping[str, object]) -> str:
    """Render ``{name}`` fields of a path template; a missing or empty key raises."""
    if not template:
        raise ValueError("empty path template")
    fields = [f for _, f, _, _ in string.Formatter().parse(template) if f]
    for f in fields:
        if f not in context or context[f] is None or str(context[f]) == "":
            raise ValueError(f"path template key {f!r} has no value")
    return template.format(**{k: context[k] for k in fields})


def run_context(execution_date: _dt.date) -> dict[str, object]:
    """Template fields for a run: calendar year, month, day and ds; ``iso_year`` and ``week`` of its ISO week."""
    iso_year_, week, _ = execution_date.isocalendar()
    return {
        "year": execution_date.year,
        "month": execution_date.month,
        "day": execution_date.day,
        "ds": execution_date.isoformat(),
        "iso_year": iso_year_,
        "week": week,
    }


def stage_json(
    spark: SparkSession, base: str, key_template: str, context: Mapping[str, object], schema: T.StructType
) -> DataFrame:
    """Staging read of the JSON files under a rendered key."""
    if not base:
        raise ValueError("missing base path")
    return scan_json(spark, f"{base.rstrip('/')}/{render_path(key_template, context).lstrip('/')}", schema)


def stage_parquet(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Truncate-and-load: the target is replaced by the source's rows."""
    if not source or not target:
        raise ValueError("stage_parquet needs source and target")
    spark.read.parquet(source).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def snapshot_columns(date_col: str | Column) -> list[Column]:
    """Snapshot partition keys of a date: ISO year and ISO week."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return [iso_year(d).alias("snap_year"), iso_week(d).alias("snap_week")]


def snapshot_path(root: str, execution_date: _dt.date) -> str:
    ctx = run_context(execution_date)
    return f"{root.rstrip('/')}/snap_year={ctx['iso_year']}/snap_week={ctx['week']}"


def read_snapshot(spark: SparkSession, root: str, execution_date: _dt.date) -> DataFrame:
    """The slice of the date's week of a snapshot-partitioned table (partition pruning)."""
    ctx = run_context(execution_date)
    return spark.read.parquet(root).where((F.col("snap_year") == ctx["iso_year"]) & (F.col("snap_week") == ctx["week"]))


def write_snapshots(df: DataFrame, date_col: str, root: str, partition_cols: Sequence[str] = SNAPSHOT_COLUMNS) -> None:
    """Write with snapshot partition columns; only the slices present are replaced."""
    write_partitioned(df.select("*", *snapshot_columns(date_col)), root, partition_cols, replace="slices")
