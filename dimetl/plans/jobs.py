"""End-to-end loads built from the library's operators.

``run_song_star``     raw song + event JSON folders -> the five star tables,
                      partitioned Parquet, gated by data-quality checks.
``run_listing_week``  one weekly listing snapshot -> staging tables -> SCD2
                      dimensions -> stock fact rows of that week (a rerun of
                      the week replaces its partition), gated by checks.

Each job stages its normalised input once as Parquet in the output folder (a
written table: columnar, and the lineage of every later write starts there
instead of at the raw JSON), then derives and writes each table.

Disk of ``run_song_star``: a write frees its shuffle files as it ends, and the
tables that grow with the log are written in slices of ``EVENTS_PER_SLICE``
events, so that shuffles take no more than a slice at a time.  What stays is
the staged log and the tables, packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimetl.functions.time import epoch_ms_to_ts
from dimetl.operators import quality as Q
from dimetl.plans import listings as L
from dimetl.plans import songplays as SP
from dimetl.schemas import DIMENSIONS
from dimetl.session import shuffles_released
from dimetl.sinks import writers as W
from dimetl.sinks.paths import exists
from dimetl.operators.filters import filter_plays, slices
from dimetl.sources import files as S

#: Events whose rows are shuffled at a time.
EVENTS_PER_SLICE = 40_000_000
#: Parquet codec of the staged log and the star tables.
PACKED = "zstd"


def normalise_log(raw: DataFrame) -> DataFrame:
    """Player log (JSON field names) -> the snake_case play-log columns of the star builder."""
    return raw.select(
        F.col("page"),
        epoch_ms_to_ts("ts").alias("start_time"),
        F.col("userId").try_cast("bigint").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
        "song",
        "artist",
        "length",
        F.col("sessionId").alias("session_id"),
        F.col("itemInSession").alias("item_in_session"),
        "location",
        F.col("userAgent").alias("user_agent"),
    )


def run_song_star(
    spark: SparkSession,
    song_root: str,
    log_root: str,
    out_root: str,
    variant: str | SP.StarRules = "lookup",
) -> dict[str, str]:
    """Build and write the song-play star schema of one model (``songplays.RULES``); returns table -> path."""
    if not song_root or not log_root or not out_root:
        raise ValueError("run_song_star needs song_root, log_root and out_root")
    with shuffles_released(spark):
        return _song_star(spark, song_root, log_root, out_root.rstrip("/"), SP.star_rules(variant))


def _song_star(spark: SparkSession, song_root: str, log_root: str, out: str, rules: SP.StarRules) -> dict[str, str]:
    songs_path, log_path, lookup_path = (f"{out}/staging/{name}" for name in ("songs", "events", "lookup"))
    n = {"n": F.count(F.lit(1))}
    W.write_parquet(S.scan_recursive(spark, song_root, S.SONG_SCHEMA), songs_path, codec=PACKED)
    events = W.write_parquet(normalise_log(S.scan_recursive(spark, log_root, S.LOG_SCHEMA)), log_path, observe=n, codec=PACKED)["n"]
    songs_raw, log = spark.read.parquet(songs_path), spark.read.parquet(log_path)
    parts, lookup = slices(events, EVENTS_PER_SLICE), None
    if len(parts) > 1:  # every slice looks songs up: they are made ready once
        W.write_parquet(SP.fact_lookup(songs_raw, rules), lookup_path, codec=PACKED)
        lookup = spark.read.parquet(lookup_path)

    paths = {name: f"{out}/{name}" for name in ("songplays", "users", "songs", "artists", "time")}
    counted = dict.fromkeys(paths, 0)
    for part in parts:
        tables, first = SP.star_schema(log, songs_raw, rules, part, lookup, deal=True), part[0] == 0
        months = {"partition_by": ["year", "month"], "replace": "all" if first else "none", "observe": n, "rebalance": False, "codec": PACKED}
        # Independent sinks: submitted as concurrent jobs, each of which counts its rows.
        writes = {
            "songplays": lambda: W.write_partitioned(tables["songplays"], paths["songplays"], **months),
            "time": lambda: W.write_partitioned(tables["time"], paths["time"], **months),
            "songs": lambda: W.write_partitioned(tables["songs"], paths["songs"], ["year"], observe=n, codec=PACKED),
            "users": lambda: W.write_parquet(tables["users"], paths["users"], "overwrite" if first else "append", n, PACKED),
            "artists": lambda: W.write_parquet(tables["artists"], paths["artists"], observe=n, codec=PACKED),
        }
        whole = ("songs", "artists")  # of one slice only
        for name, seen in W.run_writes(spark, {k: f for k, f in writes.items() if first or k not in whole}).items():
            counted[name] += seen["n"]

    written = {name: spark.read.parquet(p) for name, p in paths.items()}
    fact = written["songplays"]
    Q.assert_passed(
        Q.dq_suite(
            Q.dq_observed(spark, [("row_count", name, counted[name], 1) for name in paths]),
            Q.dq_fk_orphans(
                fact,
                {
                    "song_id": (written["songs"], "song_id"),
                    "artist_id": (written["artists"], "artist_id"),
                    "user_id": (written["users"], "user_id"),
                    "start_time": (written["time"], "start_time"),
                },
                "songplays",
            ),
        )
    )
    return paths


def run_listing_week(
    spark: SparkSession,
    raw_path: str,
    out_root: str,
    load_date: str,
    multi_line: bool = False,
    keep_versions: int | None = None,
) -> dict[str, str]:
    """One weekly load: staging, SCD2 dimensions, the week's stock fact rows, gates.

    An empty crawl, a duplicate business key or a NULL one stops the week before
    anything is loaded.  ``keep_versions`` folds dimension stores of more load partitions.
    """
    if not raw_path or not out_root or not load_date:
        raise ValueError("run_listing_week needs raw_path, out_root and load_date")
    out = out_root.rstrip("/")
    clean_path = f"{out}/staging/listings/load_date={load_date}"
    L.clean_listings(S.scan_json_subset(spark, raw_path, multi_line=multi_line)).write.mode("overwrite").parquet(clean_path)
    clean = spark.read.parquet(clean_path)
    # The four staging tables, written and gated before any presentation table is touched.
    frames = L.staging_frames(clean, load_date)
    stage_paths = {name: f"{out}/staging/{name}" for name in frames}
    W.run_writes(spark, {name: (lambda name=name: W.write_parquet(frames[name], stage_paths[name])) for name in frames})
    staging = {name: spark.read.parquet(p) for name, p in stage_paths.items()}
    keyed = {DIMENSIONS[d].base_table: (staging[DIMENSIONS[d].base_table], DIMENSIONS[d].match_columns) for d in DIMENSIONS}
    Q.assert_passed(Q.dq_suite(Q.dq_counts(staging), Q.dq_unique_keys(keyed), Q.dq_null_keys(keyed)))

    stores = L.load_dimensions(
        spark, f"{out}/presentation", list(DIMENSIONS), lambda dim, _k: staging[DIMENSIONS[dim].base_table], [load_date],
        keep_versions,
    )
    date_path = f"{out}/presentation/dim_date"
    if not exists(spark, date_path):
        W.write_parquet(L.dim_date(spark), date_path)

    fact = L.fact_stock(staging["staging_stock"], stores["dim_broker"], stores["dim_asset"], stores["dim_geography"])
    fact_path = f"{out}/presentation/fact_stock"
    W.write_partitioned(fact, fact_path, ["date_id"], replace="slices")

    written = spark.read.parquet(fact_path)
    ids = {DIMENSIONS[d].id_column: (stores[d], DIMENSIONS[d].id_column) for d in DIMENSIONS}
    Q.assert_passed(
        Q.dq_suite(
            Q.dq_counts({"fact_stock": written, **{d: t for d, t in stores.items()}}),
            Q.dq_scd2_unique({d: (t, DIMENSIONS[d].match_columns) for d, t in stores.items()}),
            Q.dq_scd2_overlap({d: (t, DIMENSIONS[d].match_columns) for d, t in stores.items()}),
            Q.dq_unique_keys({"fact_stock": (written, ["id"])}),
            Q.dq_null_keys({"fact_stock": (written, list(ids))}),
            Q.dq_fk_orphans(written, {**ids, "date_id": (spark.read.parquet(date_path), "date_id")}, "fact_stock"),
        )
    )
    return {"fact_stock": fact_path, "dim_date": date_path, **stage_paths, **{d: f"{out}/presentation/{d}" for d in stores}}
