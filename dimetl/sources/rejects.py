"""Loads that account for every record of their files: rejected records, attributes that differ between files.

``read_with_rejects`` parses permissively: a record that does not fit the
declared schema is kept as text, with its file and a reason, instead of turning
into NULLs.  ``copy_with_rejects`` loads the good rows, writes the rejects apart
and fails the load beyond a limit, before the target is touched.

``schema_report`` lists the attributes and types of every file;
``scan_merged`` reads files of differing attributes as one table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimetl.session import scratch_path

RECORD, FILE, REASON = "rejected_record", "file", "reason"
NOT_JSON, WRONG_TYPE, FIELD_COUNT = "not a JSON object", "a value of another type", "another number of fields"


class RejectLimitError(RuntimeError):
    pass


def _reason(record: Column, fmt: str, fields: int) -> Column:
    if fmt == "json":
        kind = F.schema_of_variant(F.try_parse_json(record))
        return F.when(kind.startswith("OBJECT"), F.lit(WRONG_TYPE)).otherwise(F.lit(NOT_JSON))
    # Separators inside quoted values do not count.
    found = F.size(F.split(F.regexp_replace(record, '"(?:[^"]|"")*"', ""), ","))
    return F.when(found == fields, F.lit(WRONG_TYPE)).otherwise(F.lit(FIELD_COUNT))


def read_with_rejects(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, fmt: str = "json", **options) -> DataFrame:
    """The declared columns of every record, and ``rejected_record, file, reason`` (NULL, the file, NULL for a good one).

    A missing attribute is NULL and no reject; a record with a value that does
    not fit its type, broken JSON and a CSV line with another number of fields
    are.  Headers of CSV files are skipped.
    """
    if fmt not in ("json", "csv"):
        raise ValueError(f"no rejects for files of type {fmt!r}")
    if not paths:
        raise ValueError("missing path")
    wide = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    reader = spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD)
    if fmt == "csv":
        reader = reader.option("header", "true").option("enforceSchema", "true")
    for k, v in options.items():
        reader = reader.option(k, v)
    rows = reader.format(fmt).load([paths] if isinstance(paths, str) else list(paths))
    bad = F.col(RECORD).isNotNull()
    return rows.select(
        *[F.col(f"`{c}`") for c in schema.names], RECORD, F.col("_metadata.file_path").alias(FILE),
        F.when(bad, _reason(F.col(RECORD), fmt, len(schema.names))).alias(REASON),
    )


@dataclass(frozen=True)
class LoadCounts:
    good: int
    rejected: int


def copy_with_rejects(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    target: str,
    rejects: str,
    max_rejects: int = 0,
    fmt: str = "json",
    **options,
) -> LoadCounts:
    """Load files into the Parquet table ``target``; bad records go to the table ``rejects``.

    The files are parsed once, into a scratch table whose write counts both
    kinds.  More than ``max_rejects`` bad records raise ``RejectLimitError``: the
    rejects are written for inspection, the target stays as it is.
    """
    if not target or not rejects:
        raise ValueError("copy_with_rejects needs a target and a place for rejects")
    parsed = read_with_rejects(spark, paths, schema, fmt, **options)
    seen = Observation()
    bad = F.col(RECORD).isNotNull()
    staged_path = scratch_path(spark, "copy-staged")
    parsed.observe(seen, F.count_if(~bad).alias("good"), F.count_if(bad).alias("rejected")).write.parquet(staged_path)
    counts = LoadCounts(int(seen.get["good"]), int(seen.get["rejected"]))
    staged = spark.read.schema(parsed.schema).parquet(staged_path)
    staged.where(bad).select(FILE, REASON, RECORD).write.mode("overwrite").parquet(rejects)
    if counts.rejected > max_rejects:
        raise RejectLimitError(f"{counts.rejected} rejected records, at most {max_rejects} allowed; see {rejects}")
    staged.where(~bad).select(*[F.col(f"`{c}`") for c in schema.names]).write.mode("overwrite").parquet(target)
    return counts


# ------------------------------------------------------------ differing files

#: Types an attribute widens to, in order; anything else, or a mix with text, is text.
_NUMBERS = {"BIGINT": 0, "DECIMAL": 1, "DOUBLE": 2, "FLOAT": 2}


def schema_report(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """``file, attribute, type, n_records`` of every attribute of JSON-lines files, as the files have them.

    ``type`` is the JSON value's own (``VOID`` for null).  Records that are no
    JSON object count under no attribute.
    """
    reader = spark.read
    for k, v in options.items():
        reader = reader.option(k, v)
    lines = reader.text([paths] if isinstance(paths, str) else list(paths)).select(F.col("_metadata.file_path").alias(FILE), "value")
    fields = F.from_json("value", "map<string,string>")
    parsed = lines.select(FILE, F.try_parse_json("value").alias("v"), F.map_keys(fields).alias("keys"))
    each = parsed.where(F.col("keys").isNotNull()).select(FILE, "v", F.explode(F.array_distinct("keys")).alias("attribute"))
    kind = F.regexp_extract(F.schema_of_variant(F.try_variant_get("v", F.concat(F.lit("$['"), F.col("attribute"), F.lit("']")), "variant")), "^[A-Z]+", 0)
    return each.groupBy(FILE, "attribute", kind.alias("type")).agg(F.count(F.lit(1)).alias("n_records"))


def merged_schema(report: DataFrame) -> T.StructType:
    """One schema for all files of a report: every attribute, in name order, with the narrowest type that holds all its values.

    Whole numbers and decimals widen to double, truth values stay, any other
    mix and nested values are read as text.  Only attribute names and types reach the driver.
    """
    types: dict[str, set[str]] = {}
    for r in report.select("attribute", "type").distinct().collect():
        types.setdefault(r["attribute"], set()).add(r["type"])
    out = T.StructType()
    for name in sorted(types):
        own = types[name] - {"VOID"}
        if own and own <= set(_NUMBERS):
            kind = T.LongType() if own == {"BIGINT"} else T.DoubleType()
        else:
            kind = T.BooleanType() if own == {"BOOLEAN"} else T.StringType()
        out = out.add(name, kind)
    return out


def scan_merged(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """JSON-lines files of differing attributes as one table: absent attributes are NULL, types widen as ``merged_schema`` states."""
    schema = merged_schema(schema_report(spark, paths, **options))
    reader = spark.read.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.json([paths] if isinstance(paths, str) else list(paths))
