"""Declared schemas and the table registry.

Sources are read with declared schemas (no inference pass over the input).
The registry below drives DDL (create / drop of every table of both subject
models) and the SCD2 dimension definitions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Fixed value: the open end of an SCD2 validity interval.
OPEN_END_DATE = "9999-12-31"

# --- raw sources -----------------------------------------------------------

SONG_SCHEMA = T.StructType(
    [
        T.StructField("num_songs", T.LongType()),
        T.StructField("artist_id", T.StringType()),
        T.StructField("artist_latitude", T.DoubleType()),
        T.StructField("artist_longitude", T.DoubleType()),
        T.StructField("artist_location", T.StringType()),
        T.StructField("artist_name", T.StringType()),
        T.StructField("song_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("year", T.IntegerType()),
    ]
)

# Listening log as written by the player (JSON field names as in the files).
LOG_SCHEMA = T.StructType(
    [
        T.StructField("artist", T.StringType()),
        T.StructField("auth", T.StringType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("itemInSession", T.LongType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("length", T.DoubleType()),
        T.StructField("level", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("registration", T.DoubleType()),
        T.StructField("sessionId", T.LongType()),
        T.StructField("song", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("ts", T.LongType()),
        T.StructField("userAgent", T.StringType()),
        T.StructField("userId", T.StringType()),
    ]
)

# CSV event export: 17 positional columns, header row.
CSV_EVENT_COLUMNS = [
    "artist", "auth", "firstName", "gender", "itemInSession", "lastName", "length", "level",
    "location", "method", "page", "registration", "sessionId", "song", "status", "ts", "userId",
]
CSV_EVENT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CSV_EVENT_COLUMNS])
# Fixed value: positions kept from the CSV export, in order.
CSV_KEPT_POSITIONS = [0, 2, 3, 4, 5, 6, 7, 8, 12, 13, 16]
# The event time as well, which orders the writes of the query-keyed tables.
CSV_TIMED_POSITIONS = [*CSV_KEPT_POSITIONS, 15]

# Listing attributes as crawled (numbers arrive as text).
LISTING_ATTRIBUTES = [
    "Broker", "ContractNumber", "Country", "County", "Parish", "Title", "Description",
    "PriceCurrencyFormated", "PropertyType", "Bathrooms", "Bedrooms", "AreaNet", "Latitude", "Longitude",
]
LISTING_RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in LISTING_ATTRIBUTES]
    + [
        T.StructField("FullLocation", T.StringType()),
        T.StructField("AreaGross", T.StringType()),
        T.StructField("Photo", T.StringType()),
        T.StructField("URLSEOv2", T.StringType()),
        T.StructField("EnergyCertificate", T.StringType()),
        T.StructField("ParkingSpaces", T.LongType()),
        T.StructField("Ammenities", T.ArrayType(T.StringType())),
    ]
)
LISTING_PAGE_SCHEMA = T.StructType(
    [
        T.StructField("CurrentPage", T.IntegerType()),
        T.StructField("TotalPages", T.IntegerType()),
        T.StructField("Properties", T.ArrayType(LISTING_RAW_SCHEMA)),
    ]
)

# --- target tables ---------------------------------------------------------


def _schema(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)  # type: ignore[attr-defined]


TABLES: dict[str, dict[str, str]] = {
    # song-play model
    "songplays": {
        "schema": "songplay_id string, start_time timestamp, user_id bigint, level string, song_id string, "
        "artist_id string, session_id bigint, location string, user_agent string, year int, month int",
        "namespace": "presentation",
        "partition_by": "year,month",
    },
    "users": {
        "schema": "user_id bigint, first_name string, last_name string, gender string, level string",
        "namespace": "presentation",
    },
    "songs": {
        "schema": "song_id string, title string, artist_id string, year int, duration double",
        "namespace": "presentation",
        "partition_by": "year",
    },
    "artists": {
        "schema": "artist_id string, name string, location string, latitude double, longitude double",
        "namespace": "presentation",
    },
    "time": {
        "schema": "start_time timestamp, hour int, day int, week int, month int, year int, weekday int",
        "namespace": "presentation",
        "partition_by": "year,month",
    },
    # listing model: staging
    "staging_broker": {"schema": "broker string, hash string", "namespace": "staging"},
    "staging_geography": {
        "schema": "country string, county string, parish string, hash string",
        "namespace": "staging",
    },
    "staging_asset": {
        "schema": "contract_number string, country string, county string, parish string, title string, "
        "description string, price double, property_type string, bathrooms double, bedrooms double, "
        "area_net double, latitude double, longitude double, hash string",
        "namespace": "staging",
    },
    "staging_stock": {
        "schema": "broker string, contract_number string, country string, county string, parish string, "
        "price double, quantity int, stock_date date",
        "namespace": "staging",
    },
    # listing model: presentation
    "dim_broker": {
        "schema": "broker_id string, broker string, hash string, record_start_date date, record_end_date date",
        "namespace": "presentation",
    },
    "dim_geography": {
        "schema": "geography_id string, country string, county string, parish string, hash string, "
        "record_start_date date, record_end_date date",
        "namespace": "presentation",
    },
    "dim_asset": {
        "schema": "asset_id string, contract_number string, country string, county string, parish string, "
        "title string, description string, price double, property_type string, bathrooms double, "
        "bedrooms double, area_net double, latitude double, longitude double, hash string, "
        "record_start_date date, record_end_date date",
        "namespace": "presentation",
    },
    "fact_stock": {
        "schema": "id string, broker_id string, asset_id string, geography_id string, price double, "
        "quantity int, date_id int",
        "namespace": "presentation",
    },
}


def table_schema(name: str) -> T.StructType:
    return _schema(TABLES[name]["schema"])


@dataclass(frozen=True)
class DimSpec:
    """One SCD2 dimension: target table, staging table, business keys."""

    target_table: str
    base_table: str
    match_columns: list[str]
    id_column: str
    tracked_columns: list[str] = field(default_factory=list)


DIMENSIONS: dict[str, DimSpec] = {
    "dim_broker": DimSpec("dim_broker", "staging_broker", ["broker"], "broker_id", ["broker"]),
    "dim_asset": DimSpec(
        "dim_asset",
        "staging_asset",
        ["contract_number"],
        "asset_id",
        [
            "contract_number", "country", "county", "parish", "title", "description", "price",
            "property_type", "bathrooms", "bedrooms", "area_net", "latitude", "longitude",
        ],
    ),
    "dim_geography": DimSpec(
        "dim_geography", "staging_geography", ["country", "county", "parish"], "geography_id",
        ["country", "county", "parish"],
    ),
}
