"""A key holding a third of all rows: joins are split by AQE, aggregates combine map-side."""

import pytest
from pyspark.sql import functions as F

from dimetl.operators.joins import lookup_one, natural_join
from dimetl.operators.upsert import pk_replace

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skew_session(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot(spark, n=90000):
    left = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(n).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("w"))
    return left, right


@pytest.mark.parametrize("kind", ["natural", "lookup"])
def test_hot_key_join_is_split(skew_session, kind):
    left, right = _hot(skew_session)
    if kind == "natural":
        df = natural_join(left, right, [("k", "rk")], "left")
    else:
        df = lookup_one(left, right, [("k", "rk")], take=["w"], order_by=["w"])
    rows = df.collect()
    assert len(rows) == 90000  # whole result, nothing dropped
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_aggregate_is_combined_before_shuffle(skew_session):
    left, _ = _hot(skew_session)
    df = pk_replace(left, ["k"], ["v"])
    assert df.where("k = 0").first()["v"] == 89997
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan or "partial_max" in plan
