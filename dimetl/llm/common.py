"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimetl.session import scratch_path

#: Prefix of every helper column that meets a caller's columns in one frame.
OWN = "__llm_"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage in a way that survives lost executors: the files live in
    the folder named by ``spark.checkpoint.dir``, never on one machine.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    """The text column with null read as the empty string."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def id_col(column: str) -> Column:
    return F.col(f"`{column}`").cast("long")


def hash_sample(df: DataFrame, key: Column, limit: int, spread: int = 40) -> DataFrame:
    """The rows of ``df`` that have some ``spread * limit`` of its smallest distinct hashes ``key`` (all rows of a small frame).

    Rows that share a hash pass together and count once, so repeated rows push
    nothing out.  After dropping repeats, ``orderBy(key).limit(limit)`` then
    moves a bounded number of rows however many tasks there are.
    """
    kinds = df.agg(F.approx_count_distinct(key, 0.02)).first()[0]
    if kinds <= spread * limit:
        return df
    return df.filter(key < F.lit(-(2**63) + int(2**64 * (spread * limit / kinds))))
