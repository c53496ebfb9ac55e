"""As-of joins against brute force; range layout read through file statistics."""

import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from dimetl.operators.joins import as_of_join
from dimetl.plans.listings import fact_stock
from dimetl.sinks.writers import write_range_layout
from test_skew import skew_session  # noqa: F401

LEFT = "k string, t timestamp, v int"
RIGHT = "k string, s timestamp, e timestamp, x int"


def _moment(rng):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 200))


def _data(seed, n=400):
    rng = random.Random(seed)
    keys = ["a", "b", "c", None, "only left"]
    left = [(rng.choice(keys), rng.choice([None, *[_moment(rng)] * 9]), i) for i in range(n)]
    right = []
    for i in range(n):
        s = rng.choice([None, *[_moment(rng)] * 9])
        e = None if s is None or rng.random() < 0.4 else s + dt.timedelta(hours=rng.randrange(0, 90))
        right.append((rng.choice(keys[:4]), s, e, i))
    right += right[:20]  # repeated versions
    return left, right


def _brute(left, right):
    out = []
    for k, t, v in left:
        fits = [r for r in right if r[0] == k and t is not None and r[1] is not None and r[1] <= t]
        best = max(fits, key=lambda r: (r[1], r[2] is None, r[2] or dt.datetime.min, r[3]), default=None)
        ok = best is not None and (best[2] is None or best[2] >= t)
        out.append((k, t, v, best[3] if ok else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("slice_by", [None, "day", "month"])
def test_as_of_equals_brute_force(spark, slice_by):
    left, right = _data(3)
    got = as_of_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "t", "s", ["x"], end="e", slice_by=slice_by)
    assert sorted(map(tuple, got.collect()), key=str) == _brute(left, right)


def test_as_of_without_end_and_empty_sides(spark):
    left, right = _data(5, 60)
    open_ended = [(k, s, None, x) for k, s, _, x in right]
    frame = spark.createDataFrame(left, LEFT)
    got = as_of_join(frame, spark.createDataFrame(right, RIGHT), ["k"], "t", "s", ["x"])
    assert sorted(map(tuple, got.collect()), key=str) == _brute(left, open_ended)
    none = as_of_join(frame, spark.createDataFrame([], RIGHT), [("k", "k")], "t", "s", ["x"], end="e", slice_by="day")
    assert sorted(map(tuple, none.collect()), key=str) == _brute(left, [])
    assert as_of_join(spark.createDataFrame([], LEFT), spark.createDataFrame(right, RIGHT), ["k"], "t", "s", ["x"]).count() == 0
    with pytest.raises(ValueError):
        as_of_join(frame, frame, [], "t", "t", ["v"])


def test_hot_key_of_as_of_is_split(skew_session):  # noqa: F811
    n = 60000
    left = skew_session.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.lit(dt.datetime(2024, 3, 1)).alias("t"), F.col("id").alias("v")
    )
    right = skew_session.range(n).select(F.col("id").alias("k"), F.lit(dt.datetime(2024, 1, 1)).alias("s"), (F.col("id") * 2).alias("x"))
    df = as_of_join(left, right, ["k"], "t", "s", ["x"])
    rows = df.collect()
    assert len(rows) == n and all(r["x"] == 2 * r["k"] for r in rows)
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_stock_fact_with_fifty_versions_a_key(spark):
    """Each row meets the version of its date, and overlapping versions do not double it."""
    first = dt.date(2024, 1, 1)
    spans = [(first + dt.timedelta(days=7 * i), first + dt.timedelta(days=7 * i + 6), i) for i in range(50)]
    broker = spark.createDataFrame([("b", s, e, f"b{i}") for s, e, i in spans] + [("b", first, spans[9][1], "overlap")],
                                   "broker string, record_start_date date, record_end_date date, broker_id string")
    asset = spark.createDataFrame([(c, s, e, f"{c}{i}") for c in ("c1", "c2") for s, e, i in spans],
                                  "contract_number string, record_start_date date, record_end_date date, asset_id string")
    geography = spark.createDataFrame([(None, "y", "z", s, e, f"g{i}") for s, e, i in spans],
                                      "country string, county string, parish string, record_start_date date, record_end_date date, geography_id string")
    asked = [(c, first + dt.timedelta(days=d)) for c in ("c1", "c2") for d in range(3, 360, 5)]
    stock = spark.createDataFrame([("b", c, None, "y", "z", 10.0, 1, day) for c, day in asked],
                                  "broker string, contract_number string, country string, county string, parish string, price double, quantity int, stock_date date")
    rows = fact_stock(stock, broker, asset, geography).collect()
    assert len(rows) == len(asked)
    number = {int(day.strftime("%Y%m%d")): (day - first).days // 7 for _, day in asked}
    for r in rows:
        i = number[r["date_id"]]
        want = f"{i}" if i < 50 else None
        assert r["geography_id"] == (want and f"g{want}")
        assert (r["asset_id"] or "c?None")[2:] == str(want)
        assert r["broker_id"] == (want and f"b{want}") or (i == 0 and r["broker_id"] == "overlap")


def _scanned_rows(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_range_layout_skips_files(spark, tmp_dir):
    n = 40000
    rows = spark.range(n).select(
        F.when(F.col("id") % 50 != 0, (F.col("id") * 7919) % n).alias("a"),
        F.timestamp_seconds((F.col("id") * 104729) % n).alias("b"), F.col("id"), F.lit("x").alias("odd name"),
    )
    path = f"{tmp_dir}/laid"
    write_range_layout(rows, path, ["a", "b"], files=16, point_columns=["id"])
    stored = spark.read.parquet(path)
    assert stored.columns == rows.columns and stored.exceptAll(rows).count() == 0 and stored.count() == n

    files = stored.inputFiles()

    def may_hold(name, column, low, high):
        meta = pq.ParquetFile(name.replace("file://", "")).metadata
        at = meta.schema.to_arrow_schema().get_field_index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        return any(s.max >= low and s.min <= high for s in stats)

    for column, low, high in (("a", 0, n // 8), ("a", n // 2, n // 2 + 10)):
        assert sum(may_hold(f, column, low, high) for f in files) <= len(files) // 2
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    try:
        for cond, share in ((F.col("a") < n // 8, 0.5), (F.col("b") < F.timestamp_seconds(F.lit(n // 8)), 0.5), (F.col("id") == 4321, 0.5)):
            assert _scanned_rows(stored.where(cond)) <= share * n
            assert stored.where(cond).count() == rows.where(cond).count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
        spark.conf.unset("spark.sql.codegen.wholeStage")


def test_range_layout_hot_value_empty_table_and_arguments(spark, tmp_dir):
    hot = spark.range(6000).select(F.lit(1).alias("a"), F.lit(2.5).alias("b"), "id")
    write_range_layout(hot, f"{tmp_dir}/hot", ["a", "b"], files=6)
    counts = [pq.ParquetFile(f.replace("file://", "")).metadata.num_rows for f in spark.read.parquet(f"{tmp_dir}/hot").inputFiles()]
    assert sum(counts) == 6000 and max(counts) < 3000
    write_range_layout(hot.where("a = 0"), f"{tmp_dir}/none", ["a"], files=4)
    assert spark.read.schema(hot.schema).parquet(f"{tmp_dir}/none").count() == 0
    with pytest.raises(ValueError):
        write_range_layout(hot.withColumn("t", F.lit("x")), f"{tmp_dir}/bad", ["t"], files=2)
    with pytest.raises(ValueError):
        write_range_layout(hot, f"{tmp_dir}/bad", [], files=2)
