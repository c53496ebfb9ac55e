"""Parquet / CSV / JSON sinks and table loads.

Every load validates its arguments before any work (``ValueError``).  A
partitioned write replaces the whole table (full builds) or only the
partitions it produces (``replace="slices"``, for backfills and weekly loads).
Rows are rebalanced by the partition columns first: a partition value gets few
files, a hot one is split over several tasks.  Partition columns should be
low-cardinality (year, month).  ``observe`` names numbers that the write itself
counts (aggregate columns), so a gate on them needs no second scan; they are
taken in the writing stage, after any shuffle.  ``codec`` is a Parquet codec
other than the session's.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimetl.session import apply_runtime_conf


def _check(df: DataFrame | None, path: str | None) -> None:
    if df is None:
        raise ValueError("no data to write")
    if not path:
        raise ValueError("no destination path")


def _observed(df: DataFrame, observe: Mapping[str, Column] | None) -> tuple[DataFrame, Callable[[], dict[str, object]]]:
    if not observe:
        return df, dict
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in observe.items()]), lambda: dict(seen.get)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", observe: Mapping[str, Column] | None = None, codec: str | None = None
) -> dict[str, object]:
    """Parquet write; returns the ``observe`` numbers."""
    _check(df, path)
    df, counted = _observed(df, observe)
    df.write.mode(mode).parquet(path, compression=codec)
    return counted()


def rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows dealt by the partition columns: a value gets few tasks, a hot one is split."""
    return df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    replace: str = "all",
    observe: Mapping[str, Column] | None = None,
    rebalance: bool = True,
    codec: str | None = None,
) -> dict[str, object]:
    """Partitioned Parquet write; ``replace`` is ``"all"`` (the table), ``"slices"`` (the partitions present) or ``"none"`` (append).

    Without ``rebalance`` the rows are written where they are (``rebalanced`` already).
    Returns the ``observe`` numbers.
    """
    _check(df, path)
    if not partition_by:
        raise ValueError("no partition columns")
    if replace not in ("all", "slices", "none"):
        raise ValueError(f"replace is 'all', 'slices' or 'none', not {replace!r}")
    df, counted = _observed(rebalanced(df, partition_by) if rebalance else df, observe)
    (
        df.write.mode("append" if replace == "none" else "overwrite")
        .option("partitionOverwriteMode", "dynamic" if replace == "slices" else "static")
        .partitionBy(*partition_by)
        .parquet(path, compression=codec)
    )
    return counted()


#: Types that have quantiles, so that they can be laid out by range.
RANGE_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz", "decimal")


def range_cell(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """The cell of a row in a grid of ``2 ** bits`` quantile ranges per column, as interleaved bits of the ranges.

    Cells that follow each other are near in every column.  The bounds of the
    ranges, ``2 ** bits - 1`` values a column, come from one aggregate over the
    whole frame.  NULLs count as below every bound.
    """
    types = dict(df.dtypes)
    wrong = [c for c in columns if types[c].split("(")[0] not in RANGE_TYPES]
    if wrong or not columns:
        raise ValueError(f"range layout needs number, date or timestamp columns: {wrong}")
    if not 1 <= bits * len(columns) <= 62:
        raise ValueError("range layout: the cell must fit a long")
    parts = 2**bits
    shares = [i / parts for i in range(1, parts)]
    ordinal = {c: F.unix_micros(F.col(f"`{c}`").cast("timestamp")) if types[c].startswith(("date", "timestamp")) else F.col(f"`{c}`") for c in columns}
    bounds = df.agg(*[F.percentile_approx(ordinal[c], shares, 100 * parts).alias(f"b{i}") for i, c in enumerate(columns)]).first()

    def place(c: Column, i: int, found: list, low: int, high: int) -> Column:
        """Spread bits of how many bounds a value is above, by halving: a row meets one bound a level."""
        if low == high:
            return F.lit(sum((low >> bit & 1) << (bit * len(columns) + i) for bit in range(bits))).cast("long")
        mid = (low + high) // 2
        return F.when(c > F.lit(found[mid]), place(c, i, found, mid + 1, high)).otherwise(place(c, i, found, low, mid))

    cell = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        found = sorted(set(bounds[i] or []))
        cell = cell.bitwiseOR(place(ordinal[c], i, found, 0, len(found)))
    return cell


def write_range_layout(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = 6, point_columns: Sequence[str] = ()) -> None:
    """Parquet files that each hold a box of ``columns``, so that a filter on any of them skips most files by their statistics.

    Rows are divided by range over ``range_cell``, then the columns, then a hash
    of the whole row, which splits a hot cell; rows are sorted alike in a file.
    ``point_columns`` get Bloom filters for lookups of single values.
    """
    _check(df, path)
    if files < 1:
        raise ValueError("range layout needs at least one file")
    apply_runtime_conf(df.sparkSession)  # timestamps with statistics
    order = ["__cell", *[f"`{c}`" for c in columns], "__row"]
    laid = (
        df.withColumns({"__cell": range_cell(df, columns, bits), "__row": F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])})
        .repartitionByRange(files, *order)
        .sortWithinPartitions(*order)
        .drop("__cell", "__row")
    )
    writer = laid.write.mode("overwrite")
    for c in point_columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Append-only load (fact tables)."""
    _check(df, path)
    df.write.mode("append").parquet(path)


def load_dimension(df: DataFrame, path: str, append_rows: bool = False) -> None:
    """Dimension load: truncate-insert by default, append on request."""
    _check(df, path)
    df.write.mode("append" if append_rows else "overwrite").parquet(path)


def write_csv_quoted(df: DataFrame, path: str) -> None:
    """CSV with a header row and every field quoted."""
    _check(df, path)
    df.write.mode("overwrite").option("header", "true").option("quoteAll", "true").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    _check(df, path)
    df.write.mode("overwrite").json(path)


def insert_subset(df: DataFrame, table: str, fields: Sequence[str] | None = None) -> None:
    """Insert into a catalog table; with ``fields`` only those columns are taken, the rest are NULL."""
    if df is None or not table:
        raise ValueError("insert_subset needs data and a table")
    spark = df.sparkSession
    target = spark.table(table).schema
    fields = list(fields) if fields else [f.name for f in target.fields]
    unknown = [f for f in fields if f not in target.names]
    if unknown:
        raise ValueError(f"unknown target columns: {unknown}")
    cols = [
        (F.col(f"`{f.name}`") if f.name in fields else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.fields
    ]
    df.select(*cols).write.insertInto(table)


def run_writes(spark: SparkSession, writes: Mapping[str, Callable[[], object]], max_parallel: int = 4) -> dict[str, object]:
    """Run independent writes as concurrent Spark jobs (one driver thread each); results by name.

    The threads carry the caller's job group, tags and local properties; an
    error in any write is raised after all writes have finished.
    """
    from pyspark.util import inheritable_thread_target

    if not writes:
        return {}
    with ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(writes)))) as pool:
        futures = {name: pool.submit(inheritable_thread_target(spark)(fn)) for name, fn in writes.items()}
        errors = [f.exception() for f in futures.values()]
    for err in errors:
        if err is not None:
            raise err
    return {name: f.result() for name, f in futures.items()}
