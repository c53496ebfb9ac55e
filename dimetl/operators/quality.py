"""Data-quality gates.

Each check is a lazy DataFrame of result rows with one schema
``(check_name, subject, observed, expected, passed)``; checks are unioned into
one suite and evaluated by a single job.  Only ``assert_passed`` acts: it
brings back the (tiny, one row per check) result and raises on a failure.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimetl.operators.scd2 import duplicate_active_keys, overlapping_versions


class DataQualityError(RuntimeError):
    pass


def _row(check: str, subject: str, observed: Column, expected: Column, passed: Column) -> list[Column]:
    return [
        F.lit(check).alias("check_name"),
        F.lit(subject).alias("subject"),
        observed.cast("bigint").alias("observed"),
        expected.cast("bigint").alias("expected"),
        passed.alias("passed"),
    ]


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    if not frames:
        raise ValueError("no checks given")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def dq_counts(tables: Mapping[str, DataFrame], min_rows: int = 1) -> DataFrame:
    """Row-count gate: every table must hold at least ``min_rows`` rows."""
    if not tables:
        raise ValueError("dq_counts needs at least one table")
    frames = []
    for name, df in tables.items():
        n = F.count(F.lit(1))
        frames.append(df.agg(*_row("row_count", name, n, F.lit(min_rows), n >= F.lit(min_rows))))
    return _union(frames)


def has_rows(df: DataFrame) -> bool:
    """Existence only: stops after the first row."""
    return df.limit(1).count() > 0


def dq_scd2_unique(dims: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """SCD2 gate: no business key may have two active versions."""
    frames = []
    for name, (dim, keys) in dims.items():
        n = F.count(F.lit(1))
        frames.append(duplicate_active_keys(dim, keys).agg(*_row("scd2_unique", name, n, F.lit(0), n == F.lit(0))))
    return _union(frames)


def dq_scd2_overlap(dims: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """SCD2 gate: number of versions whose validity meets that of the next version of their key (must be 0)."""
    frames = []
    for name, (dim, keys) in dims.items():
        n = F.count(F.lit(1))
        frames.append(overlapping_versions(dim, keys).agg(*_row("scd2_overlap", name, n, F.lit(0), n == F.lit(0))))
    return _union(frames)


def dq_unique_keys(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Key gate: number of keys that more than one row has (must be 0)."""
    frames = []
    for name, (df, keys) in tables.items():
        n = F.count(F.lit(1))
        twice = df.groupBy(*keys).agg(n.alias("__n")).where(F.col("__n") > 1)
        frames.append(twice.agg(*_row("unique_keys", name, n, F.lit(0), n == F.lit(0))))
    return _union(frames)


def dq_null_keys(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Key gate: number of rows with a NULL in any key column (must be 0)."""
    frames = []
    for name, (df, keys) in tables.items():
        missing = None
        for k in keys:
            term = F.col(f"`{k}`").isNull()
            missing = term if missing is None else missing | term
        n = F.count_if(missing)
        frames.append(df.agg(*_row("null_keys", name, n, F.lit(0), n == F.lit(0))))
    return _union(frames)


def dq_fk_orphans(fact: DataFrame, fks: Mapping[str, tuple[DataFrame, str]], fact_name: str = "fact") -> DataFrame:
    """Referential integrity: fact rows whose non-NULL key has no dimension row.

    All keys in one pass: the fact is read once, its keys and those of the
    dimensions, each tagged with its foreign key's number, meet in one exchange,
    pre-aggregated, so a hot key is one row there.  Whole numbers and timestamps
    that have one type on both sides are compared as longs, other keys as text.
    """
    if not fks:
        raise ValueError("no checks given")
    kinds = {fk: (dict(fact.dtypes)[fk], dict(dim.dtypes)[key]) for fk, (dim, key) in fks.items()}

    def tagged(i: int, fk: str, column: str) -> list[Column]:
        c, (own, other) = F.col(f"`{column}`"), kinds[fk]
        short = own == other and own in ("tinyint", "smallint", "int", "bigint", "timestamp")
        as_long = F.unix_micros(c) if own == "timestamp" else c.cast("bigint")
        return [F.lit(i).alias("fk"), (as_long if short else F.lit(None).cast("bigint")).alias("l"), (F.lit(None) if short else c).cast("string").alias("k")]

    own = F.array(*[F.struct(*tagged(i, fk, fk)) for i, fk in enumerate(fks)])
    sides = [fact.select(F.explode(own).alias("x")).select("x.*", F.lit(1).alias("n"), F.lit(0).alias("known"))]
    for i, (fk, (dim, key)) in enumerate(fks.items()):
        sides.append(dim.select(*tagged(i, fk, key), F.lit(0).alias("n"), F.lit(1).alias("known")))
    keys = sides[0]
    for side in sides[1:]:
        keys = keys.unionAll(side)
    met = keys.where(F.col("l").isNotNull() | F.col("k").isNotNull()).groupBy("fk", "l", "k").agg(F.sum("n").alias("n"), F.max("known").alias("known"))
    lost = [F.coalesce(F.sum(F.when((F.col("fk") == i) & (F.col("known") == 0), F.col("n"))), F.lit(0)).alias(f"n{i}") for i in range(len(fks))]
    rows = [F.struct(*_row("fk_orphans", f"{fact_name}.{fk}", F.col(f"n{i}"), F.lit(0), F.col(f"n{i}") == 0)) for i, fk in enumerate(fks)]
    return met.agg(*lost).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def dq_observed(spark: SparkSession, checks: Sequence[tuple[str, str, int, int]]) -> DataFrame:
    """Checks of numbers that a write has counted (``writers``, ``observe=``): ``(check, subject, observed, expected)``, no scan.

    A row count passes at ``expected`` or more, anything else at exactly ``expected``.
    """
    if not checks:
        raise ValueError("no checks given")
    rows = [(c, s, int(n), int(e), n >= e if c == "row_count" else n == e) for c, s, n, e in checks]
    return spark.createDataFrame(rows, "check_name string, subject string, observed bigint, expected bigint, passed boolean")


def dq_expectations(checks: Sequence[tuple[str, DataFrame, int]]) -> DataFrame:
    """Expected-vs-actual checks: each frame yields one integer value."""
    frames = []
    for name, scalar_df, expected in checks:
        value = F.col(scalar_df.columns[0]).cast("bigint")
        frames.append(
            scalar_df.select(*_row("expectation", name, value, F.lit(expected), value.eqNullSafe(F.lit(expected))))
        )
    return _union(frames)


def dq_suite(*parts: DataFrame) -> DataFrame:
    return _union(parts)


def assert_passed(results: DataFrame) -> None:
    failed = [r.asDict() for r in results.where(~F.col("passed")).collect()]
    if failed:
        raise DataQualityError(f"data quality checks failed: {failed}")
