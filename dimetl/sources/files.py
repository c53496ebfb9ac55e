"""File scans with declared schemas (JSON, CSV) and COPY-style mappings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimetl.functions.text import clean_strings
from dimetl.functions.time import epoch_ms_to_ts
from dimetl.schemas import (
    CSV_EVENT_SCHEMA,
    CSV_KEPT_POSITIONS,
    LISTING_ATTRIBUTES,
    LISTING_RAW_SCHEMA,
    LOG_SCHEMA,
    SONG_SCHEMA,
)


def _need(value, what: str) -> None:
    if value is None or (hasattr(value, "__len__") and len(value) == 0):
        raise ValueError(f"missing {what}")


def scan_json(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, **options) -> DataFrame:
    """JSON-lines scan with a declared schema (no inference pass)."""
    _need(paths, "path")
    reader = spark.read.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    paths = [paths] if isinstance(paths, str) else list(paths)
    return reader.json(paths).select(*schema.names)


def scan_json_songs(spark: SparkSession, song_root: str) -> DataFrame:
    """Song files laid out three directory levels deep: ``root/*/*/*/*.json``."""
    return scan_json(spark, f"{song_root.rstrip('/')}/*/*/*/*.json", SONG_SCHEMA)


def scan_json_events(spark: SparkSession, log_root: str) -> DataFrame:
    """Event logs laid out by year and month: ``root/*/*/*.json``."""
    return scan_json(spark, f"{log_root.rstrip('/')}/*/*/*.json", LOG_SCHEMA)


def scan_recursive(spark: SparkSession, root: str, schema: T.StructType, glob: str = "{*.json,*.json.gz}") -> DataFrame:
    """Every matching file below ``root``, at any depth; packed files are read as plain ones."""
    return scan_json(spark, root, schema, recursiveFileLookup="true", pathGlobFilter=glob)


def scan_json_subset(
    spark: SparkSession,
    path: str | Sequence[str],
    attributes: Sequence[str] = tuple(LISTING_ATTRIBUTES),
    multi_line: bool = False,
) -> DataFrame:
    """Listing files narrowed to a common attribute subset.

    Attributes absent from a file come back as NULL instead of failing.
    ``multi_line=True`` reads files holding one (indented) JSON array each;
    such a file cannot be split, so each is read by one task (one crawler
    output per site and week).  JSON lines, the default, split at any size.
    """
    df = scan_json(spark, path, LISTING_RAW_SCHEMA, multiLine=str(bool(multi_line)).lower())
    return df.select(*attributes)


def scan_csv_events(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = CSV_EVENT_SCHEMA,
    positions: Sequence[int] = tuple(CSV_KEPT_POSITIONS),
    drop_blank: str | None = "artist",
) -> DataFrame:
    """Header CSV files, positional column pick, rows with a blank ``drop_blank`` dropped."""
    _need(path, "path")
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.option("header", "true").option("mode", "PERMISSIVE").schema(schema).csv(paths)
    names = [schema.names[i] for i in positions]
    df = df.select(*names)
    if drop_blank:
        df = df.where(F.col(drop_blank).isNotNull() & (F.col(drop_blank) != ""))
    return df


def apply_json_paths(
    df: DataFrame,
    mapping: Sequence[tuple[str, str]],
    epoch_ms_columns: Sequence[str] = ("ts",),
) -> DataFrame:
    """Project a JSON-shaped frame through a JSONPaths list ``[(target, "$.a.b"), ...]``.

    Targets listed in ``epoch_ms_columns`` are converted from epoch
    milliseconds to timestamps (``timeformat 'epochmillisecs'``).
    """
    _need(mapping, "mapping")
    cols = []
    for target, jpath in mapping:
        if not jpath.startswith("$."):
            raise ValueError(f"not a JSON path: {jpath!r}")
        c = F.col(".".join(f"`{p}`" for p in jpath[2:].split(".")))
        cols.append((epoch_ms_to_ts(c) if target in epoch_ms_columns else c).alias(target))
    return df.select(*cols)


def copy_json_mapped(
    spark: SparkSession,
    path: str | Sequence[str],
    mapping: Sequence[tuple[str, str]],
    source_schema: T.StructType = LOG_SCHEMA,
    epoch_ms_columns: Sequence[str] = ("ts",),
) -> DataFrame:
    """COPY with a JSONPaths list, in target column order."""
    return apply_json_paths(scan_json(spark, path, source_schema), mapping, epoch_ms_columns)


def copy_json_auto(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """COPY ``'auto'``: fields matched to the declared target columns by name."""
    return scan_json(spark, path, schema)


def copy_clean(df: DataFrame, max_lengths: dict[str, int] | None = None, default_max_length: int | None = None) -> DataFrame:
    """COPY flags ``TRUNCATECOLUMNS BLANKSASNULL EMPTYASNULL`` on every string column."""
    return clean_strings(df, max_lengths, default_max_length, blanks_as_null=True, empty_as_null=True, truncate=True)


def union_files(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Bag union of several file sets in one scan."""
    _need(paths, "paths")
    return scan_json(spark, list(paths), schema)


def ingest_counts(df: DataFrame) -> DataFrame:
    """Rows per input file of a file-based frame."""
    return df.select(F.input_file_name().alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"))
