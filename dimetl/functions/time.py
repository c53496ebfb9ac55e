"""Time conversions and calendar attributes (all JVM-side built-ins).

Timestamps are UTC: the session time zone is pinned to UTC by
``dimetl.session``; ``timestamp_ntz`` inputs are cast to ``timestamp``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_timestamp(c: str | Column) -> Column:
    """Zone-less or string timestamps -> ``timestamp`` in the (UTC) session zone."""
    return _c(c).cast("timestamp")


def epoch_ms_to_ts(c: str | Column) -> Column:
    """Epoch milliseconds -> timestamp, milliseconds kept."""
    return F.timestamp_millis(_c(c))


def epoch_ms_to_ts_seconds(c: str | Column) -> Column:
    """Epoch milliseconds -> timestamp with the milliseconds dropped (``ts div 1000``)."""
    return F.timestamp_seconds(F.floor(_c(c) / F.lit(1000)))


def ts_to_epoch_ms(c: str | Column) -> Column:
    return F.unix_millis(as_timestamp(c))


def weekday(c: str | Column, convention: str = "sunday0") -> Column:
    """Weekday in the three conventions found in the models.

    ``sunday0``: 0 = Sunday .. 6 = Saturday; ``sunday1``: 1 = Sunday .. 7;
    ``name``: English day name.
    """
    if convention == "sunday0":
        return (F.dayofweek(_c(c)) - F.lit(1)).cast("int")
    if convention == "sunday1":
        return F.dayofweek(_c(c)).cast("int")
    if convention == "name":
        return F.date_format(_c(c), "EEEE")
    raise ValueError(f"unknown weekday convention: {convention!r}")


def iso_week(c: str | Column) -> Column:
    return F.weekofyear(_c(c))


def iso_year(c: str | Column) -> Column:
    """The year that owns the ISO week (2018-12-31 -> 2019)."""
    return F.extract(F.lit("YEAROFWEEK"), _c(c)).cast("int")


def date_id(c: str | Column) -> Column:
    """``YYYYMMDD`` integer date key."""
    return F.date_format(_c(c), "yyyyMMdd").cast("int")


def time_parts(c: str | Column, weekday_convention: str = "sunday0") -> list[Column]:
    """Columns of the ``time`` dimension for a timestamp column."""
    ts = _c(c)
    return [
        ts.alias("start_time"),
        F.hour(ts).alias("hour"),
        F.dayofmonth(ts).alias("day"),
        F.weekofyear(ts).alias("week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        weekday(ts, weekday_convention).alias("weekday"),
    ]


def calendar_columns(d: str | Column) -> list[Column]:
    """Attributes of the calendar dimension for a ``date`` column."""
    d = _c(d)
    dow = F.dayofweek(d)
    return [
        date_id(d).alias("date_id"),
        F.date_format(d, "yyyy-MM-dd").alias("full_date"),
        F.year(d).alias("year_number"),
        F.weekofyear(d).alias("week_iso_number"),
        F.dayofyear(d).alias("day_number"),
        F.quarter(d).alias("quarter_number"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        dow.cast("int").alias("weekday_number"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.when(dow.isin(1, 7), F.lit(0)).otherwise(F.lit(1)).alias("is_weekday"),
        F.when(F.last_day(d) == d, F.lit(1)).otherwise(F.lit(0)).alias("is_last_of_month"),
    ]


def date_spine(spark: SparkSession, start: str | _dt.date, days: int) -> DataFrame:
    """``days + 1`` consecutive dates from ``start``, generated in parallel by ``range``."""
    if days < 0:
        raise ValueError("days must be >= 0")
    start_lit = F.lit(str(start)).cast("date")
    return spark.range(0, days + 1).select(F.date_add(start_lit, F.col("id").cast("int")).alias("full_date"))


def date_spine_between(bounds: DataFrame, lo: str, hi: str) -> DataFrame:
    """Every date between the two date columns of a one-row ``bounds`` frame.

    The spine length is bounded by the calendar span, not by the data size.
    """
    return bounds.select(F.explode(F.sequence(F.col(lo).cast("date"), F.col(hi).cast("date"))).alias("full_date"))
