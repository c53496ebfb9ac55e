"""Natural-key joins.

The physical strategy is left to Catalyst + AQE (sort-merge by default,
converted to broadcast at run time when a side's measured shuffle output is
small; skewed partitions split by the AQE skew-join rule).  No broadcast hint
is placed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Float keys are compared at fixed scale (e.g. song durations).
DECIMAL_KEY_TYPE = "decimal(18,5)"

KeyPairs = Sequence[tuple[str, str]]


def _pairs(keys: Sequence[str] | KeyPairs) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in keys]


def _key(df_alias: str, name: str, as_decimal: bool) -> Column:
    c = F.col(f"{df_alias}.`{name}`")
    return c.cast(DECIMAL_KEY_TYPE) if as_decimal else c


def natural_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] | KeyPairs,
    how: str = "inner",
    decimal_keys: Sequence[str] = (),
    right_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Equi-join on (left, right) key pairs, keeping every match (fan-out).

    Returns all left columns plus ``right_columns`` (default: the right
    columns that are not keys).  ``decimal_keys`` names left-side keys that
    are compared as ``decimal(18,5)``.
    """
    pairs = _pairs(keys)
    if not pairs:
        raise ValueError("natural_join needs at least one key")
    dec = set(decimal_keys)
    cond = None
    for lk, rk in pairs:
        term = _key("l", lk, lk in dec) == _key("r", rk, lk in dec)
        cond = term if cond is None else cond & term
    rkeys = {rk for _, rk in pairs}
    if right_columns is None:
        right_columns = [c for c in right.columns if c not in rkeys]
    out = left.alias("l").join(right.alias("r"), cond, how)
    return out.select(*[F.col(f"l.`{c}`") for c in left.columns], *[F.col(f"r.`{c}`") for c in right_columns])


def lookup_one(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] | KeyPairs,
    take: Sequence[str],
    order_by: Sequence[str],
    decimal_keys: Sequence[str] = (),
) -> DataFrame:
    """Left join that returns at most one match per left row.

    The right side is first reduced to one row per key (the row with the
    smallest ``order_by`` tuple, a total order), so the join cannot fan out
    and unmatched rows keep NULLs.  The reduction is a partial (map-side)
    aggregate, so a hot key is combined before the shuffle.
    """
    pairs = _pairs(keys)
    dec = set(decimal_keys)
    rk_exprs = []
    for lk, rk in pairs:
        c = F.col(f"`{rk}`")
        rk_exprs.append((c.cast(DECIMAL_KEY_TYPE) if lk in dec else c).alias(f"__k_{rk}"))
    ordering = F.struct(*[F.col(f"`{c}`") for c in order_by])
    payload = F.struct(*[F.col(f"`{c}`") for c in take])
    reduced = (
        right.groupBy(*rk_exprs)
        .agg(F.min_by(payload, ordering).alias("__hit"))
        .select(*[F.col(f"__k_{rk}") for _, rk in pairs], *[F.col(f"__hit.`{c}`").alias(c) for c in take])
    )
    cond = None
    for lk, rk in pairs:
        term = _key("l", lk, lk in dec) == F.col(f"r.__k_{rk}")
        cond = term if cond is None else cond & term
    out = left.alias("l").join(reduced.alias("r"), cond, "left")
    return out.select(*[F.col(f"l.`{c}`") for c in left.columns], *[F.col(f"r.`{c}`") for c in take])


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] | KeyPairs,
    at: str,
    start: str,
    take: Sequence[str],
    end: str | None = None,
    slice_by: str | None = None,
) -> DataFrame:
    """Left join with the last version of the key that starts at or before ``at``: one row per left row.

    ``right`` holds versions that start at ``start`` and, with ``end``, hold up to
    and including it (NULL: open); a version that has ended by ``at`` gives NULLs.
    Of versions with one start the one with the latest end stays, then the
    largest ``take`` values.  Keys meet NULL-safely; a NULL ``at`` finds nothing.

    The distinct (key, ``at``) pairs are ordered among the versions in one window
    per key, so a key with many versions costs one sort and no row meets more than
    one version; the left rows then meet their pair in an equi-join that AQE can
    split.  A window holds a key's distinct ``at`` values.  Where these are not
    bounded (fine timestamps of a hot key), ``slice_by``, a unit of
    ``date_trunc``, divides it by time: a slice holds its own pairs, and what held
    before it comes from the last versions of the slices.
    """
    pairs = _pairs(keys)
    if not pairs or not take:
        raise ValueError("as_of_join needs at least one key and one column to take")
    names = [f"__k{i}" for i in range(len(pairs))]
    until = F.col(f"`{end}`") if end else F.lit(None).cast("timestamp")
    version = F.struct(until.isNull().alias("open"), until.alias("until"), *[F.col(f"`{c}`").alias(f"t{i}") for i, c in enumerate(take)])
    versions = (
        right.select(*[F.col(f"`{rk}`").alias(n) for (_, rk), n in zip(pairs, names)], F.col(f"`{start}`").alias("__at"), version.alias("__v"))
        .where(F.col("__at").isNotNull())
        .groupBy(*names, "__at")
        .agg(F.max("__v").alias("__v"))
        .withColumn("__ask", F.lit(False))
    )
    asked = (
        left.select(*[F.col(f"`{lk}`").alias(n) for (lk, _), n in zip(pairs, names)], F.col(f"`{at}`").alias("__at"))
        .where(F.col("__at").isNotNull())
        .distinct()
        .withColumn("__ask", F.lit(True))
    )
    both = versions.unionByName(asked, allowMissingColumns=True)
    within = list(names)
    if slice_by:
        both = both.withColumn("__slice", F.date_trunc(slice_by, "__at"))
        within.append("__slice")
    # Of one moment the version comes before the question.
    upto = Window.partitionBy(*within).orderBy("__at", "__ask").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("__v", F.last("__v", ignorenulls=True).over(upto)).where("__ask")
    if slice_by:
        before = Window.partitionBy(*names).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
        carried = (
            both.groupBy(*within)
            .agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.col("__at"))).alias("__own"))
            .select(*within, F.last("__own", ignorenulls=True).over(before).alias("__before"))
        )
        same = None
        for n in within:
            term = F.col(f"s.{n}").eqNullSafe(F.col(f"c.{n}"))
            same = term if same is None else same & term
        seen = seen.alias("s").join(carried.alias("c"), same, "left").select(
            *[F.col(f"s.{n}") for n in names], F.col("s.__at"), F.coalesce("s.__v", "c.__before").alias("__v")
        )
    cond = F.col(f"l.`{at}`") == F.col("r.__at")
    for (lk, _), n in zip(pairs, names):
        cond = F.col(f"l.`{lk}`").eqNullSafe(F.col(f"r.{n}")) & cond
    holds = F.col("r.__v.open") | (F.col("r.__v.until") >= F.col("r.__at"))
    out = left.alias("l").join(seen.alias("r"), cond, "left")
    return out.select(
        *[F.col(f"l.`{c}`") for c in left.columns],
        *[F.when(holds, F.col(f"r.__v.t{i}")).alias(c) for i, c in enumerate(take)],
    )


def fk_orphans(fact: DataFrame, fk: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact rows whose non-NULL foreign key has no row in the dimension."""
    keys = dim.select(F.col(f"`{dim_key}`").alias("__dk"))
    return fact.where(F.col(f"`{fk}`").isNotNull()).join(keys, F.col(f"`{fk}`") == F.col("__dk"), "left_anti")
