"""Catalog management: namespaces and the table set from one registry.

Tables are ``USING parquet`` with explicit locations under a given root (the
shared warehouse or checkpoint folder), never the process working directory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from dimetl.schemas import TABLES
from dimetl.sinks.paths import delete


def create_schema(spark: SparkSession, name: str, root: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{root.rstrip('/')}/{name}.db'")


def create_tables(spark: SparkSession, names: Sequence[str], root: str) -> list[str]:
    """``CREATE TABLE IF NOT EXISTS`` for registry tables; returns qualified names."""
    created = []
    for name in names:
        spec = TABLES[name]
        ns = spec["namespace"]
        create_schema(spark, ns, root)
        part = f" PARTITIONED BY ({spec['partition_by']})" if spec.get("partition_by") else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {ns}.{name} ({spec['schema']}) USING parquet{part} "
            f"LOCATION '{root.rstrip('/')}/{ns}.db/{name}'"
        )
        created.append(f"{ns}.{name}")
    return created


def drop_tables(spark: SparkSession, names: Sequence[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {TABLES[name]['namespace']}.{name}")


def recreate_tables(spark: SparkSession, names: Sequence[str], root: str) -> list[str]:
    """Idempotent drop + create of *empty* tables (staging tables are recreated for every run).

    The tables have locations, whose files a drop leaves behind: they go too.
    """
    drop_tables(spark, names)
    for name in names:
        delete(spark, f"{root.rstrip('/')}/{TABLES[name]['namespace']}.db/{name}")
    return create_tables(spark, names, root)


def insertion_columns(spark: SparkSession, table: str, exclude: Sequence[str] = ("id",)) -> list[str]:
    """Columns of a catalog table in table order, without the surrogate id column(s)."""
    return [c for c in spark.table(table).columns if c not in set(exclude)]


def temp_view_query(df: DataFrame, view: str, sql: str) -> DataFrame:
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql)


def save_bucketed(
    df: DataFrame,
    table: str,
    path: str,
    bucket_cols: Sequence[str],
    num_buckets: int,
    sort_cols: Sequence[str] = (),
) -> None:
    """Catalog table hash-bucketed by ``bucket_cols`` and sorted within buckets.

    Joins and aggregations on the bucket columns between tables with the same
    bucket count need no shuffle, and an equality filter on the bucket columns
    reads one bucket (distribution and sort keys of a warehouse table).
    """
    if df is None or not table or not path or not bucket_cols or num_buckets < 1:
        raise ValueError("save_bucketed needs data, table, path, bucket columns and a bucket count")
    writer = df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(num_buckets, *bucket_cols)
    if sort_cols:
        writer = writer.sortBy(*sort_cols)
    writer.saveAsTable(table)
