"""Property test: random load sequences keep the SCD2 invariants, and the three implementations agree."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimetl.functions.keys import row_hash
from dimetl.operators.scd2 import Scd2Table, scd2_apply, scd2_bulk
from dimetl.schemas import OPEN_END_DATE

OPEN = dt.date.fromisoformat(OPEN_END_DATE)
DAYS = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22"]
TARGET = "dim_id string, k string, v string, hash string, record_start_date date, record_end_date date"

loads_strategy = st.lists(
    st.dictionaries(st.sampled_from(["a", "b", "c", "d"]), st.sampled_from(["1", "2", "3"]), max_size=4),
    min_size=1,
    max_size=len(DAYS),
)


def _staging(spark, rows):
    df = spark.createDataFrame(sorted(rows.items()) or [], "k string, v string")
    return df.withColumn("hash", row_hash("k", "v"))


def _check(rows):
    by_key = {}
    for r in rows:
        by_key.setdefault(r["k"], []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r["record_start_date"])
        assert sum(r["record_end_date"] == OPEN for r in versions) == 1
        for a, b in zip(versions, versions[1:]):
            assert a["record_end_date"] == b["record_start_date"] - dt.timedelta(days=1)
            assert a["v"] != b["v"]  # a new version only on a change


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(loads=loads_strategy)
def test_random_loads(spark, tmp_path_factory, loads):
    target = spark.createDataFrame([], TARGET)
    snaps = None
    store = Scd2Table(spark, str(tmp_path_factory.mktemp("scd2")), ["k"], "dim_id")
    for day, rows in zip(DAYS, loads):
        s = _staging(spark, rows)
        target = scd2_apply(target, s, ["k"], day, "dim_id")
        target = spark.createDataFrame(target.collect(), target.schema)
        store.load(s, day)
        s2 = s.withColumn("snapshot_date", F.lit(day).cast("date"))
        snaps = s2 if snaps is None else snaps.unionByName(s2)
    replay = sorted(map(tuple, target.collect()))
    _check(target.collect())
    bulk = scd2_bulk(snaps, ["k"], "snapshot_date", "dim_id").select(*target.columns)
    assert sorted(map(tuple, bulk.collect())) == replay
    assert sorted(map(tuple, store.read().select(*target.columns).collect())) == replay
