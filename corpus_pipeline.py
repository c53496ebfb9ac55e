"""Corpus pipeline: documents to packed training sequences in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept.  All but the last return the columns of ``documents``; the last
returns the packed pieces.  Between stages the rows are written as Parquet to
the shared scratch folder and read again, so a lost executor costs one stage
at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimetl.llm import exact_dedup, packing, pii, quality, simhash
from dimetl.llm.common import materialise
from dimetl.llm.queries import table, tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled rows among ``docs``, does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked fingerprints (4-word shingles, at most 4 bits) the document with the smallest id."""
    return simhash.one_of_each(docs, shingle=simhash.SHINGLE, max_bits=simhash.MAX_BITS)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data masked in every text; ``n_chars`` follows."""
    masked = pii.mask_personal_data(docs)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: No SQL for the classifier, the fingerprints, the tagger and the packing; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
