"""Incremental loads.

``ingest_available_now``: file-by-file ingest as a Structured Streaming query
with ``trigger(availableNow=True)``.  The checkpoint records which files were
committed, so a rerun ingests only new files; each micro-batch is written to
its own ``(source, batch_id)`` partition with overwrite, so a replayed batch
(after a failure between write and commit) replaces its own output instead of
duplicating it, and sources that share a target never meet.  A target that
holds rows of a source is refused if that source's checkpoint is gone.

``stream_upsert_available_now``: a first/last-wins dimension kept by a file
stream.  The running values live in Spark's state store (a streaming aggregate
in update mode); each micro-batch writes the rows of the keys it changed, and
only those, to its own partition, so a batch costs its input and not the table.

``backfill_slice``: recompute and rewrite time slices of a partitioned table;
dynamic partition overwrite leaves every other slice untouched, and a named
slice without rows is emptied.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimetl.operators.upsert import merge_first_last
from dimetl.sinks.paths import delete, exists, partition_values
from dimetl.sinks.writers import write_partitioned

BATCH = "batch_id"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ingest_available_now(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_trigger: int | None = None,
    file_format: str = "json",
) -> None:
    """Ingest every file not yet committed under ``source_dir`` into ``target``."""
    if not source_dir or not target or not checkpoint:
        raise ValueError("ingest_available_now needs source_dir, target and checkpoint")
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source_dir)
    source = "s" + hashlib.md5(source_dir.rstrip("/").encode("utf-8")).hexdigest()[:16]
    if exists(spark, f"{target.rstrip('/')}/source={source}") and not exists(spark, checkpoint):
        raise ValueError(f"{target} holds rows of {source_dir}, but its checkpoint {checkpoint} is not there")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        (
            out.withColumns({"source": F.lit(source), "batch_id": F.lit(batch_id).cast("long")})
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("source", "batch_id")
            .parquet(target)
        )

    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def backfill_slice(
    table: DataFrame,
    slice_rows: DataFrame,
    path: str,
    partition_by: Sequence[str],
    slices: Sequence[Mapping[str, object]] = (),
) -> None:
    """Replace the partitions present in ``slice_rows``; all others stay as they are.

    ``slices`` names the partitions that were recomputed (a value for each
    partition column): those without rows in ``slice_rows`` are emptied.
    ``table`` is only used to validate the schema of the slice.
    """
    if list(slice_rows.columns) != list(table.columns):
        raise ValueError("slice columns differ from the table's")
    if any(set(s) != set(partition_by) for s in slices):
        raise ValueError("a slice needs a value for each partition column")
    spark = slice_rows.sparkSession
    write_partitioned(slice_rows, path, partition_by, replace="slices")
    if not slices:
        return
    types = T.StructType([slice_rows.schema[c] for c in partition_by])
    named = spark.createDataFrame([tuple(s[c] for c in partition_by) for s in slices], _nullable(types)).distinct()
    written = slice_rows.select(*partition_by).distinct()
    empty = named.join(written, _same(named, written, partition_by), "left_anti")
    # One row per named slice that has no rows any more; its folder is told by the files Spark finds in it.
    stored = spark.read.parquet(path)
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    stored = stored.select(*[F.col(f"`{c}`").cast(types[c].dataType).alias(c) for c in partition_by], folder.alias("__folder"))
    gone = stored.join(empty, _same(stored, empty, partition_by), "left_semi").select("__folder").distinct()
    for row in gone.collect():
        delete(spark, row["__folder"], encoded=True)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]):
    cond = None
    for c in columns:
        term = left[c].eqNullSafe(right[c])
        cond = term if cond is None else cond & term
    return cond


class StreamedTable:
    """A dimension as the rows each micro-batch changed, one ``batch_id`` partition per batch.

    A key's row is that of its last batch.  ``fold`` writes the rows of all
    batches but the last into one partition (the last may still be replayed).
    """

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str], schema: T.StructType | None = None):
        if not root or not key:
            raise ValueError("StreamedTable needs root and key")
        self.spark, self.root, self.key, self.schema = spark, root.rstrip("/"), list(key), schema

    def batches(self) -> list[int]:
        return sorted(map(int, partition_values(self.spark, self.root, BATCH)))

    def read(self, at_most: int | None = None) -> DataFrame:
        """The table as of the last batch (or of batch ``at_most``)."""
        if not self.batches():
            if self.schema is None:
                raise ValueError(f"no batch under {self.root}")
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.parquet(self.root)
        if at_most is not None:
            rows = rows.where(F.col(BATCH) <= at_most)
        rest = [c for c in rows.columns if c not in {*self.key, BATCH}]
        last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.col(BATCH)).alias("__r")
        return rows.groupBy(*self.key).agg(last).select(*self.key, *[F.col(f"__r.`{c}`").alias(c) for c in rest])

    def write(self, rows: DataFrame, batch: int) -> None:
        """Write a batch's changed rows; a replayed batch replaces its own."""
        (
            rows.withColumn(BATCH, F.lit(batch).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH)
            .parquet(self.root)
        )

    def fold(self, keep: int = 2) -> list[int]:
        """Fold the table if it has more than ``keep`` batches (at least 2); returns the batches folded away."""
        if keep < 2:
            raise ValueError("keep at least two batches: the last one may be replayed")
        batches = self.batches()
        if len(batches) <= keep:
            return []
        self.write(self.read(at_most=batches[-2]), batches[-2])
        for b in batches[:-2]:
            delete(self.spark, f"{self.root}/{BATCH}={b}")
        return batches[:-2]


def stream_upsert_available_now(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    root: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame],
    key: Sequence[str],
    first_cols: Sequence[str],
    last_cols: Sequence[str],
    order_cols: Sequence[str],
    max_files_per_trigger: int | None = None,
    file_format: str = "json",
    keep_batches: int | None = None,
) -> StreamedTable:
    """Maintain a first/last-wins dimension from a file stream; returns the table.

    The stream aggregates by key with ``merge_first_last`` in update mode, its
    state in the RocksDB state store under ``checkpoint``.  The merge does not
    depend on order, so file arrival order, batching and replays after a
    failure do not change the result.  ``keep_batches`` folds a table of more
    partitions after the run.  A target that holds rows is refused if the
    checkpoint, and with it the state, is gone.
    """
    if not source_dir or not root or not checkpoint or not key:
        raise ValueError("stream_upsert_available_now needs source_dir, root, checkpoint and key")
    if keep_batches is not None and keep_batches < 2:
        raise ValueError("keep at least two batches: the last one may be replayed")
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    running = merge_first_last(None, prepare(reader.load(source_dir)), key, first_cols, last_cols, order_cols)
    table = StreamedTable(spark, root, key, running.schema)
    if table.batches() and not exists(spark, checkpoint):
        raise ValueError(f"{root} holds a table, but its checkpoint {checkpoint} is not there")

    provider = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        query = (
            running.writeStream.outputMode("update")
            .foreachBatch(table.write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, provider)
    if keep_batches:
        table.fold(keep_batches)
    return table
