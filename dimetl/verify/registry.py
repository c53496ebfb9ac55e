"""Registry of verification queries: key -> (Spark callable, DuckDB oracle SQL).

Every query reads the driver tables (or data Spark derives from them and
writes under the shared checkpoint folder) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def finish(df: DataFrame) -> DataFrame:
    """Verification output: zone-less timestamps and ISO date text.

    UTC timestamp values are unchanged.  Dates are handed over as
    ``yyyy-MM-dd`` text (the open end ``9999-12-31`` does not fit a
    nanosecond timestamp); the oracle casts its dates the same way
    (``dates=`` of ``register``).  Decimals are handed over as doubles
    (``doubles=``), the type both engines give to every client.
    """
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            casts[f.name] = F.col(f"`{f.name}`").cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DateType):
            casts[f.name] = F.col(f"`{f.name}`").cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            casts[f.name] = F.col(f"`{f.name}`").cast("double")
    return df.withColumns(casts) if casts else df


def dates_as_text(sql: str, dates: tuple[str, ...]) -> str:
    repl = ", ".join(f"CAST(CAST({c} AS DATE) AS VARCHAR) AS {c}" for c in dates)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n)"


def doubles_as_double(sql: str, cols: tuple[str, ...]) -> str:
    repl = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n)"


def register(key: str, sql: str | None = None, dates: tuple[str, ...] = (), doubles: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            text = dates_as_text(sql.strip(), dates) if dates else sql.strip()
            ORACLES[key] = doubles_as_double(text, doubles) if doubles else text
        return fn

    return deco


def load_all() -> None:
    from dimetl.verify import q_io, q_listings, q_pages, q_songs  # noqa: F401
