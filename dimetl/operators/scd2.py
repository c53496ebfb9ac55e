"""Type-2 slowly changing dimensions on plain Parquet.

Row model: the dimension's own columns, ``hash`` (change hash over the
tracked columns), ``record_start_date`` and ``record_end_date``; the open end
is ``9999-12-31``.  ``<dim>_id`` is a deterministic key of
(business keys, start date), so reloading the same data yields the same ids.

One load (``scd2_merge``) is a single full outer join of the *active* rows
with the staging rows on the business keys (NULL-safe), classified per key:

* key only in the target (gone from staging) -> unchanged, stays active;
* same hash                                   -> unchanged;
* hash changed                                -> old version closed at
  ``load_date - 1``, new version opened at ``load_date`` (a version opened
  on the same ``load_date`` is replaced instead, so ``end >= start`` always);
* key only in staging                         -> new version opened.

A business key that occurs twice in the staging rows stops the load with an
error (``unique_rows``): which of two rows is the version is not ours to pick.

``Scd2Table`` stores each load's opened and closed rows, never the unchanged
ones, as one ``load_date`` partition of an ordinary Parquet table; the current
state of a version is its row of the last load that has one.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimetl.functions.keys import hash_key
from dimetl.schemas import OPEN_END_DATE
from dimetl.sinks.paths import delete, partition_values

START = "record_start_date"
END = "record_end_date"
HASH = "hash"
LOAD = "load_date"
KEPT, OPENED, CLOSED, REPLACED = "kept", "opened", "closed", "replaced"


def _date(d: str | _dt.date | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(str(d)).cast("date")


def _open_end() -> Column:
    return F.lit(OPEN_END_DATE).cast("date")


def active_rows(target: DataFrame) -> DataFrame:
    return target.where(F.col(END) == _open_end())


def _key_cond(keys: Sequence[str], a: str = "t", b: str = "s") -> Column:
    cond = None
    for k in keys:
        term = F.col(f"{a}.`{k}`").eqNullSafe(F.col(f"{b}.`{k}`"))
        cond = term if cond is None else cond & term
    return cond


def unique_rows(staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The staging rows; a business key with more than one row fails the job that reads them."""
    rest = [c for c in staging.columns if c not in set(keys)]
    n = F.count(F.lit(1))
    shown = F.concat_ws(", ", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("NULL")) for k in keys])
    row = F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.col(HASH))
    grouped = staging.groupBy(*keys).agg(row.alias("__r"), n.alias("__n"))
    checked = F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("duplicate business key in staging: "), shown))).otherwise(F.col("__r"))
    return grouped.withColumn("__r", checked).select(*keys, *[F.col(f"__r.`{c}`").alias(c) for c in rest])


def scd2_close(target: DataFrame, staging: DataFrame, keys: Sequence[str], load_date) -> DataFrame:
    """Active versions whose hash changed, with ``end = load_date - 1``."""
    s = staging.select(*keys, F.col(HASH).alias("__new_hash"))
    joined = active_rows(target).alias("t").join(s.alias("s"), _key_cond(keys), "inner")
    changed = joined.where(F.col(f"t.{HASH}") != F.col("s.__new_hash"))
    return changed.select("t.*").withColumn(END, F.date_sub(_date(load_date), 1))


def scd2_open(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    load_date,
    id_column: str | None = None,
) -> DataFrame:
    """Staging rows that are new or changed against the *active* versions."""
    a = active_rows(target).select(*keys, F.col(HASH).alias("__old_hash"))
    joined = staging.alias("s").join(a.alias("t"), _key_cond(keys, "s", "t"), "left")
    picked = joined.where(F.col("t.__old_hash").isNull() | (F.col("t.__old_hash") != F.col(f"s.{HASH}")))
    out = picked.select("s.*").withColumn(START, _date(load_date)).withColumn(END, _open_end())
    if id_column:
        out = out.select(hash_key(*keys, START).alias(id_column), *[c for c in out.columns])
    return out


def scd2_merge_rows(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    load_date,
    id_column: str,
) -> DataFrame:
    """Every row one SCD2 load produces, tagged in ``change``: kept / opened / closed / replaced.

    One full outer join, one pass over ``target``, which may be the whole table
    or its active rows only: history rows match no staging row and are kept.
    ``replaced`` are versions opened on ``load_date`` itself that change again
    that day; they are no part of the table any more.
    """
    if not keys:
        raise ValueError("scd2_merge needs business keys")
    if HASH not in staging.columns:
        raise ValueError("staging needs a 'hash' column")
    load = _date(load_date)
    stage_cols = list(staging.columns)
    out_cols = [id_column, *stage_cols, START, END]
    stg = unique_rows(staging, keys).select(*stage_cols)

    open_row = F.col(f"t.{END}") == _open_end()
    j = target.select(*out_cols).alias("t").join(stg.alias("s"), _key_cond(keys) & open_row, "full_outer")
    t_present = F.col(f"t.{START}").isNotNull()
    s_present = F.col(f"s.{HASH}").isNotNull()
    changed = t_present & s_present & (F.col(f"t.{HASH}") != F.col(f"s.{HASH}"))
    same_day = F.col(f"t.{START}") == load

    t_struct = F.struct(*[F.col(f"t.`{c}`").alias(c) for c in out_cols])
    s_struct = F.struct(
        hash_key(*[F.col(f"s.`{k}`") for k in keys], load).alias(id_column),
        *[F.col(f"s.`{c}`").alias(c) for c in stage_cols],
        load.alias(START),
        _open_end().alias(END),
    )
    ended = F.when(same_day, F.lit(None).cast("date")).otherwise(F.date_sub(load, 1))
    closed_struct = F.struct(*[F.col(f"t.`{c}`").alias(c) for c in out_cols if c != END], ended.alias(END))
    gone = F.when(same_day, F.lit(REPLACED)).otherwise(F.lit(CLOSED))
    rows = F.array(
        F.when(t_present & ~F.coalesce(changed, F.lit(False)), F.struct(F.lit(KEPT).alias("change"), t_struct.alias("r"))),
        F.when(changed, F.struct(gone.alias("change"), closed_struct.alias("r"))),
        F.when(s_present & (~t_present | changed), F.struct(F.lit(OPENED).alias("change"), s_struct.alias("r"))),
    )
    return j.select(F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("x")).select(
        *[F.col(f"x.r.`{c}`").alias(c) for c in out_cols], F.col("x.change").alias("change")
    )


def scd2_merge(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    load_date,
    id_column: str,
) -> tuple[DataFrame, DataFrame]:
    """One SCD2 load as ``(new_active, newly_closed)`` (two views of ``scd2_merge_rows``)."""
    rows = scd2_merge_rows(active_rows(target), staging, keys, load_date, id_column)
    return rows.where(F.col("change").isin(KEPT, OPENED)).drop("change"), rows.where(F.col("change") == CLOSED).drop("change")


def scd2_apply(target: DataFrame, staging: DataFrame, keys: Sequence[str], load_date, id_column: str) -> DataFrame:
    """The whole table after one load: history and the load's rows from one pass over ``target``."""
    return scd2_merge_rows(target, staging, keys, load_date, id_column).where(F.col("change") != REPLACED).drop("change")


def scd2_bulk(snapshots: DataFrame, keys: Sequence[str], date_col: str, id_column: str) -> DataFrame:
    """Fold N ordered snapshots into SCD2 rows in one pass.

    A version starts at every snapshot where the key's hash differs from its
    previous appearance; it ends the day before the next version starts, or
    stays open.  Keys that disappear stay active (as with one-by-one loads).
    """
    # One row per key and snapshot (more fail, as one by one), so the per-key window
    # holds at most one row per load, whatever the data volume.
    rest = [c for c in snapshots.columns if c not in set(keys) | {date_col}]
    snapshots = unique_rows(snapshots, [*keys, date_col]).select(*keys, date_col, *rest)
    w = Window.partitionBy(*keys).orderBy(F.col(date_col))
    marked = snapshots.withColumn("__prev", F.lag(HASH).over(w))
    starts = marked.where(F.col("__prev").isNull() | (F.col("__prev") != F.col(HASH))).drop("__prev")
    w2 = Window.partitionBy(*keys).orderBy(F.col(date_col))
    nxt = F.lead(F.col(date_col)).over(w2)
    out = starts.withColumn(END, F.coalesce(F.date_sub(nxt, 1), _open_end())).withColumn(
        START, F.col(date_col).cast("date")
    )
    cols = [*keys, *rest]
    return out.select(hash_key(*keys, START).alias(id_column), *cols, START, END)


def duplicate_active_keys(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Business keys with more than one active version (must be empty)."""
    return active_rows(dim).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_active")).where(F.col("n_active") > 1)


def overlapping_versions(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions valid on a day on which a later version of their key is valid too (must be empty).

    Looks at the whole history, not only at active rows: within a key, in
    order of start, a version must end before the next one starts.  NULL keys
    are one key.  Versions that end before they start count as well.
    """
    order = Window.partitionBy(*keys).orderBy(F.col(START), F.col(END))
    marked = dim.withColumn("__next", F.lead(START).over(order))
    return marked.where((F.col("__next") <= F.col(END)) | (F.col(END) < F.col(START))).drop("__next")


class Scd2Table:
    """A type-2 dimension kept as one Parquet partition per load date.

    ``root/load_date=<day>/`` holds the versions the load of that day opened
    and, with their end date, those it closed.  A version is named by its id
    (business keys and start date), so the table is, for each id, the row of the
    last load: one aggregate.  A load replaces its own partition by dynamic
    overwrite; loads come in date order, and a second load of one day is merged
    into that day.  ``fold`` bounds the number of partitions.  One writer per
    table at a time; a frame read before a load of the same day or a fold must be
    read again.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], id_column: str):
        if not root or not keys or not id_column:
            raise ValueError("Scd2Table needs root, keys and id_column")
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.id_column = id_column
        self._schema: T.StructType | None = None

    def load_dates(self) -> list[str]:
        """Dates of the loads that changed something, in order."""
        return partition_values(self.spark, self.root, LOAD)

    def _rows(self) -> DataFrame:
        return self.spark.read.parquet(self.root).withColumn(LOAD, F.col(LOAD).cast("date"))

    def read(self) -> DataFrame:
        """Every version, history and active."""
        if not self.load_dates():
            if self._schema is None:
                raise ValueError(f"no load under {self.root}")
            return self.spark.createDataFrame([], self._schema)
        rows = self._rows()
        rest = [c for c in rows.columns if c not in (self.id_column, LOAD)]
        last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.col(LOAD)).alias("__r")
        return rows.groupBy(self.id_column).agg(last).select(self.id_column, *[F.col(f"__r.`{c}`").alias(c) for c in rest])

    def read_active(self) -> DataFrame:
        return active_rows(self.read())

    def load(self, staging: DataFrame, load_date) -> None:
        """Apply one staging load.

        An earlier date than the last one is an error (rebuild with
        ``scd2_bulk`` instead).  On the date of the last load, versions opened
        that day are replaced where they changed, and kept where staging does
        not name them.  A load that changes nothing writes nothing.
        """
        day = str(load_date)
        self._schema = T.StructType(
            [T.StructField(self.id_column, T.StringType())]
            + list(staging.schema.fields)
            + [T.StructField(START, T.DateType()), T.StructField(END, T.DateType())]
        )
        out_cols = self._schema.names
        dates = self.load_dates()
        if dates and day < dates[-1]:
            raise ValueError(f"load date {day} is before the last load {dates[-1]} of {self.root}")
        changes = scd2_merge_rows(self.read_active().select(*out_cols), staging, self.keys, load_date, self.id_column)
        written = changes.where(F.col("change").isin(OPENED, CLOSED))
        if dates and day == dates[-1]:
            # The day's partition is written anew: versions opened earlier that day and still there, closings of that day.
            still = changes.where((F.col("change") == KEPT) & (F.col(START) == _date(day)))
            closed = self._rows().where((F.col(LOAD) == _date(day)) & (F.col(START) < _date(day)))
            written = written.unionByName(still).drop("change").unionByName(closed.select(*out_cols))
        self._write(written.select(*out_cols), day)

    def _write(self, rows: DataFrame, day: str) -> None:
        (
            rows.withColumn(LOAD, F.lit(day))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(LOAD)
            .parquet(self.root)
        )

    def fold(self, keep: int = 1) -> list[str]:
        """Fold the table into the partition of its last load if it has more than ``keep``; returns the dates folded away.

        The last partition then names every version, and older partitions say
        nothing any more, so it does no harm if their removal is cut short.
        """
        if keep < 1:
            raise ValueError("keep at least one load")
        dates = self.load_dates()
        if len(dates) <= keep:
            return []
        self._write(self.read(), dates[-1])
        for day in dates[:-1]:
            delete(self.spark, f"{self.root}/{LOAD}={day}")
        return dates[:-1]
