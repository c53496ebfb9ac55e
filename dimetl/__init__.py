"""dimetl: dimensional ETL on Spark.

Lazy ``DataFrame -> DataFrame`` operators for schema'd ingest, cleaning,
star-schema builds, upserts, SCD2 dimensions, partitioned loads,
incremental file ingest and data-quality gates.
"""

__version__ = "0.1.0"
