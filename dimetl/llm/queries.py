"""Registered queries of the training-data operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimetl.llm import align, audit, chat_format, exact_dedup, maxscore, packing, pieces, pii, quality, records, secrets, simhash, wrappers

QueryFn = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of an installed public tokenizer file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id"
    )


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and conversation -1 whose texts hold the template's own control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    return chat_format.conversation_digests(rows.unionByName(extra))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_pages(table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents")).select(
        "doc_id", *(f"n_{k}" for k in pii.KINDS), F.sha2("base_text", 256).alias("base_sha256"), "spans"
    )


def op7_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded to piece ids and decoded again; the digests are of the ids and the decoded text."""
    path = tokenizer_path("piece_bpe_32k.model")
    decoded = pieces.decode_documents(pieces.encode_documents(table(spark, sf_dir, "documents"), path), path)
    return decoded.select("doc_id", "n_ids", "ids_crc32", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 of every vector whose id is divisible by 100, against all vectors."""
    vectors = maxscore.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return maxscore.top_k(vectors.filter(F.col("id") % 100 == 0), vectors)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_text", 256).alias("base_sha256"), "spans"
    )


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text written as framed binary records, and read back."""
    return records.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


QUERIES: dict[str, QueryFn] = {
    "op1_simhash_dedup": op1_simhash_dedup,
    "op2_chat_format": op2_chat_format,
    "op3_main_text": op3_main_text,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality": op5_quality,
    "op6_personal_data": op6_personal_data,
    "op7_piece_round_trip": op7_piece_round_trip,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_secret_scan": op9_secret_scan,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_filter_audit": op11_filter_audit,
    "op12_token_alignment": op12_token_alignment,
    "op13_token_records": op13_token_records,
}

ORACLES: dict[str, str] = {
    "op2_chat_format": chat_format.SQL.strip(),
    "op4_exact_dedup": exact_dedup.SQL.strip(),
    "op8_exact_top_k": maxscore.SQL.strip(),
    "op11_filter_audit": audit.SQL.strip(),
}
