"""Listing warehouse: staging, SCD2 dimensions, stock fact, calendar.

raw listings -> ``clean_listings`` -> four staging frames (broker, geography,
asset, stock) -> SCD2 loads of the three dimensions -> ``fact_stock``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimetl.functions.keys import hash_key, row_hash
from dimetl.functions.text import fill_missing, limit_length, parse_price_text, rename_snake, strip_tags
from dimetl.functions.time import calendar_columns, date_id, date_spine
from dimetl.operators.joins import as_of_join
from dimetl.operators.scd2 import Scd2Table
from dimetl.schemas import DIMENSIONS
from dimetl.sinks.writers import run_writes

# Cleaning rules of the listing attributes.
NUMERIC_ATTRIBUTES = ["AreaNet", "Bathrooms", "Bedrooms", "PriceCurrencyFormated", "Latitude", "Longitude"]
TEXTUAL_ATTRIBUTES = ["Broker", "Country", "County", "Description", "Parish", "PropertyType", "Title"]
TEXT_LIMIT = 250
CALENDAR_START = "2018-01-01"
CALENDAR_DAYS = 30 * 365

ASSET_COLUMNS = DIMENSIONS["dim_asset"].tracked_columns
GEOGRAPHY_COLUMNS = DIMENSIONS["dim_geography"].tracked_columns
STOCK_COLUMNS = ["broker", "contract_number", "country", "county", "parish", "price"]


def clean_listings(raw: DataFrame, text_limit: int = TEXT_LIMIT) -> DataFrame:
    """Fill, strip tags, cut title and description to ``text_limit``, rename price, snake-case every column.

    Change hashes are taken after the cut, so an edit behind ``text_limit``
    characters is no change.
    """
    df = raw
    if "PriceCurrencyFormated" in df.columns:
        price = F.col("PriceCurrencyFormated").cast("string")
        df = df.withColumn("PriceCurrencyFormated", F.when(price.isNull(), None).otherwise(parse_price_text(price)))
    df = fill_missing(df, NUMERIC_ATTRIBUTES, TEXTUAL_ATTRIBUTES)
    df = df.withColumns({"Description": strip_tags("Description"), "Title": strip_tags("Title")})
    df = df.withColumnRenamed("PriceCurrencyFormated", "Price")
    df = df.withColumns({"Description": limit_length("Description", text_limit), "Title": limit_length("Title", text_limit)})
    return rename_snake(df)


def _with_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("hash", row_hash(*df.columns))


def staging_broker(clean: DataFrame) -> DataFrame:
    return _with_hash(clean.select("broker").distinct())


def staging_geography(clean: DataFrame) -> DataFrame:
    return _with_hash(clean.select(*GEOGRAPHY_COLUMNS).distinct())


def staging_asset(clean: DataFrame) -> DataFrame:
    return _with_hash(clean.select(*ASSET_COLUMNS).distinct())


def staging_stock(clean: DataFrame, stock_date) -> DataFrame:
    return clean.select(*STOCK_COLUMNS).withColumns(
        {"quantity": F.lit(1), "stock_date": F.lit(str(stock_date)).cast("date")}
    )


def staging_frames(clean: DataFrame, stock_date) -> dict[str, DataFrame]:
    return {
        "staging_broker": staging_broker(clean),
        "staging_geography": staging_geography(clean),
        "staging_asset": staging_asset(clean),
        "staging_stock": staging_stock(clean, stock_date),
    }


def load_dimensions(
    spark: SparkSession,
    root: str,
    dims: Sequence[str],
    staging_for: Callable[[str, int], DataFrame],
    load_dates: Sequence[str],
    keep_versions: int | None = None,
) -> dict[str, DataFrame]:
    """Replay ``len(load_dates)`` loads into one ``Scd2Table`` per dimension.

    Loads of one dimension run in date order; the dimensions are independent,
    so their jobs are submitted from one thread each and run side by side.
    With ``keep_versions`` a store of more load partitions is folded after the loads.
    Returns the whole table (history + active) of every dimension.
    """
    if not root or not dims or not load_dates:
        raise ValueError("load_dimensions needs root, dims and load dates")

    def run(dim: str) -> DataFrame:
        spec = DIMENSIONS[dim]
        store = Scd2Table(spark, f"{root.rstrip('/')}/{dim}", spec.match_columns, spec.id_column)
        for k, day in enumerate(load_dates):
            store.load(staging_for(dim, k), day)
        if keep_versions:
            store.fold(keep_versions)
        return store.read()

    return run_writes(spark, {dim: (lambda dim=dim: run(dim)) for dim in dims}, len(dims))


def fact_stock(stock: DataFrame, dim_broker: DataFrame, dim_asset: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Stock rows with the surrogate ids of the dimension versions valid on ``stock_date``.

    As-of joins: keys meet NULL-safely, as the dimensions are keyed, and a stock
    row stays one row whatever versions its keys have.
    """
    out = stock.select("broker", "contract_number", "country", "county", "parish", "price", "quantity", "stock_date")
    for dim, spec in ((dim_asset, "dim_asset"), (dim_broker, "dim_broker"), (dim_geography, "dim_geography")):
        out = as_of_join(
            out, dim, DIMENSIONS[spec].match_columns, "stock_date", "record_start_date", [DIMENSIONS[spec].id_column], end="record_end_date"
        )
    return out.select(
        hash_key(F.col("broker"), F.col("contract_number"), F.col("stock_date")).alias("id"),
        "broker_id", "asset_id", "geography_id",
        F.col("price").cast("double").alias("price"), F.col("quantity").cast("int").alias("quantity"),
        date_id(F.col("stock_date")).alias("date_id"),
    )


def dim_date(spark: SparkSession, start: str = CALENDAR_START, days: int = CALENDAR_DAYS) -> DataFrame:
    """Calendar dimension over a date spine (ordered by date id)."""
    return date_spine(spark, start, days).select(*calendar_columns("full_date")).orderBy("date_id")


def new_stock(current: DataFrame, previous: DataFrame, keys=("broker", "contract_number")) -> DataFrame:
    """Listings in this snapshot that were not in the previous one."""
    return current.join(previous.select(*keys), list(keys), "left_anti")


def deleted_stock(current: DataFrame, previous: DataFrame, keys=("broker", "contract_number")) -> DataFrame:
    """Listings of the previous snapshot that are gone now."""
    return previous.join(current.select(*keys), list(keys), "left_anti")


def price_oscillations(current: DataFrame, previous: DataFrame, keys=("broker", "contract_number")) -> DataFrame:
    """Listings present in both snapshots whose price changed."""
    p = previous.select(*keys, F.col("price").alias("previous_price"), F.col("stock_date").alias("previous_date"))
    j = current.join(p, list(keys), "inner").where(F.col("price") != F.col("previous_price"))
    return j.select(*keys, "previous_date", "previous_price", F.col("stock_date").alias("current_date"),
                    F.col("price").alias("current_price"))
