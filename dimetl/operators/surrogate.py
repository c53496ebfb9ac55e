"""Surrogate keys.

Default: deterministic hash keys (``dimetl.functions.keys.hash_key``), which
need no coordination between tasks.  ``dense_ids`` gives gap-free ids
``0..n-1`` in key order without a single-task global window:

1. range-partition and sort by the order columns (parallel sort);
2. ``monotonically_increasing_id`` = (partition index << 33) + row in partition;
3. per-partition row counts (one row per partition) -> running offsets;
4. id = offset of the partition + row in partition (broadcast of the offset
   table, whose size is the partition count, not the data size).

The sorted frame is checkpointed to the shared checkpoint folder first, so
steps 2-4 see exactly the same partitioning even after an executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimetl.session import checkpoint_root


def dense_ids(df: DataFrame, order_cols: Sequence[str], id_column: str = "id", start: int = 0) -> DataFrame:
    if not order_cols:
        raise ValueError("dense_ids needs order columns (a total order)")
    spark = df.sparkSession
    checkpoint_root(spark)
    ordered = df.orderBy(*order_cols).checkpoint(eager=True)
    mono = ordered.withColumn("__mono", F.monotonically_increasing_id())
    part = F.shiftright(F.col("__mono"), 33)
    with_part = mono.withColumn("__part", part).withColumn("__row", F.col("__mono") - F.shiftleft(F.col("__part"), 33))
    counts = with_part.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # The offset table has one row per partition: a tiny, bounded window.
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    out = with_part.join(F.broadcast(offsets), "__part")
    return out.select(
        (F.col("__off") + F.col("__row") + F.lit(start)).cast("bigint").alias(id_column), *df.columns
    )
