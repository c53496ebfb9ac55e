"""Session construction and shared-storage scratch paths.

Every operator in the library is a lazy ``DataFrame -> DataFrame`` function;
this module only holds the few settings the library relies on:

* UTC session time zone (timestamps are UTC everywhere, never process-local);
* adaptive query execution with partition coalescing and skew-join splitting,
  so join strategies and post-shuffle partition counts are picked at run time;
* dynamic partition overwrite, so a backfill rewrites only the partitions it
  produces;
* shuffles cut into many small partitions that AQE joins up to 32 MB, so a
  task's rows, and its memory, do not grow with the input;
* Parquet timestamps as 64-bit microseconds, which have statistics to skip by
  (the 96-bit form has none).

Scratch data (round-trip files, SCD2 versions, dense-id checkpoints) always
lives under the cluster's shared ``spark.checkpoint.dir``.  Only when that is
unset (local runs, tests) does the library pick a local folder itself.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "dimetl",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Runtime SQL settings the operators assume (safe on a shared session)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    for key in ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        spark.conf.set(key, SESSION_CONF[key])


#: Spark removes an execution's shuffle files as it ends; else they stay until the driver's JVM collects garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within it, every action frees its shuffle files as it ends, so that a job's disk is that of its largest step."""
    before = spark.conf.get(RELEASE)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from the running context first, then from ``spark.checkpoint.dir``;
    only in local mode, when neither is set, a fresh local folder is created
    and registered; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="dimetl-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/dimetl/{name}-{uuid.uuid4().hex[:12]}"
