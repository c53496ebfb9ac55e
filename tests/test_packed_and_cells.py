from pyspark.sql import functions as F

from dimetl.schemas import LOG_SCHEMA
from dimetl.sinks.writers import range_cell
from dimetl.sources.files import scan_recursive


def test_packed_json_is_scanned(spark, tmp_dir):
    rows = spark.range(5).select(F.col("id").alias("ts"))
    rows.write.json(f"{tmp_dir}/in/plain")
    rows.write.option("compression", "gzip").json(f"{tmp_dir}/in/packed")
    assert scan_recursive(spark, f"{tmp_dir}/in", LOG_SCHEMA).count() == 10


def test_a_cell_is_found_by_halving(spark):
    df = spark.range(0, 1000, 1, 2).select(F.when(F.col("id") > 0, F.col("id")).alias("a"), (F.col("id") % 7).alias("b"))
    cell = range_cell(df, ["a", "b"])
    got = [r["c"] for r in df.select(cell.alias("c")).orderBy(F.col("a").asc_nulls_first()).collect()]
    ranges = [sum((c >> (2 * bit) & 1) << bit for bit in range(6)) for c in got]
    assert ranges == sorted(ranges) and ranges[0] == 0 and max(ranges) == 63
    # A row meets one bound a level, not every bound for every bit.
    assert cell._jc.toString().count(">") < 200
