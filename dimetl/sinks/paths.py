"""Folders of tables on any Hadoop file system: existence, removal, partition values."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str, encoded: bool = False):
    """``(file system, path)`` of the JVM for a folder or file; ``encoded``: as Spark names files in its metadata."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path) if encoded else path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str, encoded: bool = False) -> bool:
    fs, p = file_system(spark, path, encoded)
    return bool(fs.exists(p) and fs.delete(p, True))


def partition_values(spark: SparkSession, root: str, column: str) -> list[str]:
    """Values of the first partition column of the table at ``root``, in text order; none where there is no table."""
    fs, p = file_system(spark, root)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n[len(column) + 1 :] for n in names if n.startswith(f"{column}="))
