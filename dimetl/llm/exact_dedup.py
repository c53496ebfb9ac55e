"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

Every text is cut into content-defined chunks: a chunk ends at the first white
space between certain letters (``BOUNDARY``, rare enough to skip most word
ends) that follows ``min_chunk`` characters, and after ``max_chunk`` characters
at the latest, so a boundary depends on nearby content only and chunks fall
into step again behind an insertion.  A chunk's identifier is its 64-bit hash; the identifiers of a
document, in order, are its recipe.  Other scripts are cut at the ends of their
clauses; unspaced text without any such sign only by length.

The identifiers are *verified*: all chunks are reduced to distinct
``(hash, chunk)`` pairs (map-side first, so a chunk that a third of the rows
share moves once per task), and any hash that stands for more than one chunk
gets an ordinal per chunk, which is added to the recipes that use it.  After
that, two texts are equal exactly when their recipes are, and only recipes,
about 3 % of the text, are shuffled, grouped and joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimetl.llm.common import OWN, id_col, materialise, text_or_empty

MIN_CHUNK = 64
MAX_CHUNK = 4096
#: Where a chunk may end: one word end in some forty, by the letters around the white space; in other scripts (from U+0370
#: on) after a sign and white space between two such letters, or after a sign of unspaced scripts. One character class leads
#: all forms, so that most places are told by a single test.
BOUNDARY = (
    r"[dgy\u0370-\uFFFF](?:[.,]?\s(?=[b-hB-H])"
    r"|(?:[.,!?;:\u060C\u061B\u061F\u06D4]|(?<=\u0964))\s(?=[\u0370-\uFFFF])"
    r"|(?<=[\u3001\u3002\uFF01\uFF0C\uFF1A\uFF1B\uFF1F]))"
)


def chunks_of(text: Column, min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK) -> Column:
    """Content-defined chunks of a text; they concatenate to the text."""
    cut = rf"(?s).{{{min_chunk},{max_chunk - 3}}}?{BOUNDARY}|.{{1,{max_chunk}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def chunk_hash(chunk: Column, bits: int = 64) -> Column:
    h = F.xxhash64(chunk)
    return h if bits >= 64 else F.pmod(h, F.lit(1 << bits))


def _shared_hashes(chunks: DataFrame) -> DataFrame:
    """The hashes ``h`` that more than one chunk has, told over all chunks; only hashes move after the chunks' own shuffle."""
    return chunks.distinct().groupBy("h").count().filter("count > 1").select("h")


def _ordinals(chunks: DataFrame, shared: DataFrame) -> DataFrame:
    """``(h, chunk, ordinal)`` of the chunks whose hash is among ``shared``."""
    order = Window.partitionBy("h").orderBy("chunk")
    return chunks.join(shared, "h").distinct().withColumn("ordinal", F.row_number().over(order))


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chunk: int = MIN_CHUNK,
    max_chunk: int = MAX_CHUNK,
    hash_bits: int = 64,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Equal texts are identical strings (no normalisation); null counts as the
    empty text.  The row with the largest id stays (``keep_id``); a null id is
    smaller than any other.  Of rows that repeat both id and text exactly one
    has ``kept`` true.
    ``hash_bits`` under 64 forces hash collisions, for tests.  An empty table
    gives an empty result; other columns are ignored.
    """
    src = docs.select(id_col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    cut = src.withColumn("chunks", chunks_of(F.col("text"), min_chunk, max_chunk))

    # One pass over the texts: recipes, never the texts, go to the scratch table.
    recipes = materialise(
        cut.select(
            F.monotonically_increasing_id().alias("uid"),
            "doc_id",
            F.sha2("text", 256).alias("text_sha256"),
            F.transform("chunks", lambda c: chunk_hash(c, hash_bits)).alias("recipe"),
        ),
        "dedup-recipes",
    )

    pieces = cut.select(F.explode("chunks").alias("chunk")).select(chunk_hash(F.col("chunk"), hash_bits).alias("h"), "chunk")
    hashes = materialise(_shared_hashes(pieces), "dedup-shared-hashes")
    if hashes.isEmpty():
        recipes = recipes.withColumn("ordinals", F.array().cast("array<struct<pos:int,ordinal:int>>"))
    else:
        shared = materialise(_ordinals(pieces, hashes), "dedup-ordinals")
        used = (
            cut.select("doc_id", F.sha2("text", 256).alias("text_sha256"), F.posexplode("chunks").alias("pos", "chunk"))
            .withColumn("h", chunk_hash(F.col("chunk"), hash_bits))
            .join(shared, ["h", "chunk"])
            .groupBy("doc_id", "text_sha256")
            .agg(F.sort_array(F.collect_set(F.struct("pos", "ordinal"))).alias("found"))
            .withColumnsRenamed({"doc_id": "id2", "text_sha256": "sha2"})
        )
        recipes = (
            recipes.join(used, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("text_sha256") == F.col("sha2")), "left")
            .withColumn("ordinals", F.coalesce("found", F.array().cast("array<struct<pos:int,ordinal:int>>")))
            .select("uid", "doc_id", "text_sha256", "recipe", "ordinals")
        )

    # Groups are written out so that the join below has two plain exchanges, which AQE can split at a hot recipe.
    groups = materialise(
        recipes.groupBy("recipe", "ordinals").agg(
            F.max(F.struct("doc_id", "uid")).alias("keep"), F.count(F.lit(1)).alias("group_size")
        ),
        "dedup-groups",
    )
    return recipes.join(groups, ["recipe", "ordinals"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("uid") == F.col("keep.uid")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = (
        exact_dedup(docs, id_column, text_column)
        .filter("kept")
        .select(F.col("doc_id").alias(f"{OWN}id"), F.col("text_sha256").alias(f"{OWN}sha"))
    )
    own = docs.withColumn(f"{OWN}key", id_col(id_column)).withColumn(f"{OWN}text_sha", F.sha2(text_or_empty(text_column), 256))
    same = F.col(f"{OWN}key").eqNullSafe(F.col(f"{OWN}id")) & (F.col(f"{OWN}text_sha") == F.col(f"{OWN}sha"))
    out = own.join(kept, same, "left_semi")
    # Repeated rows (same id, same text) pass the semi join together; one of them stays.
    repeated = own.groupBy(f"{OWN}key", f"{OWN}text_sha").count().filter("count > 1")
    if not repeated.isEmpty():
        out = out.dropDuplicates([f"{OWN}key", f"{OWN}text_sha"])
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


SQL = """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
