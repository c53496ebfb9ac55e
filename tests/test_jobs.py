import json
import os

from pyspark.sql import functions as F

from dimetl.plans.jobs import run_listing_week, run_song_star

SONGS = [
    {"num_songs": 1, "artist_id": "AR1", "artist_latitude": None, "artist_longitude": None, "artist_location": "",
     "artist_name": "Vesna Marek", "song_id": "SO1", "title": "Paper Lanterns", "duration": 181.25, "year": 0},
    {"num_songs": 1, "artist_id": "AR2", "artist_latitude": 1.5, "artist_longitude": 2.5, "artist_location": "Porto",
     "artist_name": "Ana", "song_id": "SO2", "title": "Fado", "duration": 200.0, "year": 2001},
]


def _event(i, page, song=None, artist=None, length=None, level="free", user="10"):
    return {"artist": artist, "auth": "Logged In", "firstName": "Ana", "gender": "F", "itemInSession": i,
            "lastName": "Silva", "length": length, "level": level, "location": "Lisbon", "method": "PUT",
            "page": page, "registration": 1.0, "sessionId": 338, "song": song, "status": 200,
            "ts": 1541121934796 + i * 1000, "userAgent": "test", "userId": user}


def _write_lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows) + "\n")


def test_song_star_job(spark, tmp_dir):
    for s in SONGS:
        _write_lines(f"{tmp_dir}/song_data/A/B/C/{s['song_id']}.json", [s])
    events = [
        _event(0, "Home"),
        _event(1, "NextSong", "Paper Lanterns", "Vesna Marek", 181.25),
        _event(2, "NextSong", "Unknown", "Nobody", 1.0, level="paid"),
        _event(3, "NextSong", "Fado", "Ana", 200.0, level="paid", user="11"),
    ]
    _write_lines(f"{tmp_dir}/log_data/2018/11/2018-11-01-events.json", events)
    paths = run_song_star(spark, f"{tmp_dir}/song_data", f"{tmp_dir}/log_data", f"{tmp_dir}/out")
    fact = spark.read.parquet(paths["songplays"])
    assert fact.count() == 3
    assert fact.where(F.col("song_id").isNotNull()).count() == 2
    users = {r["user_id"]: r["level"] for r in spark.read.parquet(paths["users"]).collect()}
    assert users == {10: "paid", 11: "paid"}
    assert spark.read.parquet(paths["time"]).count() == 3
    # rerun is idempotent (same deterministic keys, partitions replaced)
    run_song_star(spark, f"{tmp_dir}/song_data", f"{tmp_dir}/log_data", f"{tmp_dir}/out")
    assert spark.read.parquet(paths["songplays"]).count() == 3


def _listing(cn, price, broker="B1", parish="Moreira"):
    return {"Broker": broker, "ContractNumber": cn, "Country": "Portugal", "County": "Maia", "Parish": parish,
            "Title": f"T2 <b>{cn}</b>", "Description": "<p>nice <a href='/x'>flat</a></p>",
            "PriceCurrencyFormated": price, "PropertyType": "Flat", "Bathrooms": "1", "Bedrooms": "2",
            "AreaNet": "80", "Latitude": "41.2", "Longitude": "-8.6"}


def test_listing_weeks(spark, tmp_dir):
    weeks = {
        "2024-01-01": [_listing("C1", "250 000,00 €"), _listing("C2", "100 000 €")],
        "2024-01-08": [_listing("C1", "240 000,00 €"), _listing("C3", "90 000 €", broker="B2", parish="Nogueira")],
    }
    paths = None
    for day, rows in weeks.items():
        raw = f"{tmp_dir}/raw/{day}"
        os.makedirs(raw)
        with open(f"{raw}/bot.json", "w", encoding="utf-8") as fh:
            json.dump(rows, fh, indent=2)
        paths = run_listing_week(spark, raw, f"{tmp_dir}/wh", day, multi_line=True, keep_versions=1)
    from dimetl.operators.scd2 import Scd2Table

    asset = Scd2Table(spark, paths["dim_asset"], ["contract_number"], "asset_id").read()
    assert asset.count() == 4  # C1 twice (price change), C2, C3
    assert asset.where("record_end_date = DATE'9999-12-31'").count() == 3
    fact = spark.read.parquet(paths["fact_stock"])
    assert fact.count() == 4
    assert fact.where(F.col("asset_id").isNull() | F.col("broker_id").isNull() | F.col("geography_id").isNull()).count() == 0
    week2 = {r["price"] for r in fact.where("date_id = 20240108").collect()}
    assert week2 == {240000.0, 90000.0}


def test_empty_or_duplicate_week_stops_before_loading(spark, tmp_dir):
    import pytest

    from dimetl.operators.quality import DataQualityError

    def run(day, rows):
        raw = f"{tmp_dir}/raw/{len(os.listdir(tmp_dir + '/raw'))}"
        os.makedirs(raw)
        with open(f"{raw}/bot.json", "w", encoding="utf-8") as fh:
            json.dump(rows, fh)
        return run_listing_week(spark, raw, f"{tmp_dir}/wh", day, multi_line=True)

    os.makedirs(f"{tmp_dir}/raw")
    paths = run("2024-01-01", [_listing("C1", "1 €")])
    for bad in ([], [_listing("C1", "1 €"), _listing("C1", "2 €")], [_listing(None, "1 €"), _listing("C2", "1 €")]):
        with pytest.raises(DataQualityError):
            run("2024-01-08", bad)
    assert spark.read.parquet(paths["fact_stock"]).count() == 1
    assert spark.read.parquet(paths["dim_date"]).count() == 10951


def test_full_build_replaces_older_partitions(spark, tmp_dir):
    for year, ts in ((2018, 1541121934796), (2019, 1572657934796)):
        _write_lines(f"{tmp_dir}/s{year}/A/B/C/x.json", [{**SONGS[1], "year": year}])
        event = {**_event(1, "NextSong", "Fado", "Ana", 200.0), "ts": ts}
        _write_lines(f"{tmp_dir}/l{year}/{year}/11/e.json", [event])
        paths = run_song_star(spark, f"{tmp_dir}/s{year}", f"{tmp_dir}/l{year}", f"{tmp_dir}/out")
    assert [r["year"] for r in spark.read.parquet(paths["songplays"]).collect()] == [2019]
    assert [r["year"] for r in spark.read.parquet(paths["songs"]).collect()] == [2019]
