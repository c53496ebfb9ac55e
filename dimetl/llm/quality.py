"""Quality classifier: nearest-neighbour voting in a latent semantic space.

A text is described by counts over its whole length: hashed trigrams of
character shapes (letters, capitals, digits, each sign by itself) and a few
whole-text statistics on repetition and shape.  On a bounded sample of labelled
rows the weighted counts are reduced by a truncated singular value
decomposition (latent semantic analysis); the labelled vectors, a few hundred
kilobytes whatever the corpus, go to every task.  Every document is projected,
its cosines with all labelled vectors are computed exactly in blocks, and the
labels of its nearest neighbours vote with weights that grow with similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimetl.llm.common import OWN, hash_sample, id_col, text_or_empty

#: Bound of the labelled sample: at most so many rows of each label (smallest id hashes).
SAMPLE_PER_LABEL = 1500
BUCKETS = 1024
DIMENSIONS = 48
NEIGHBOURS = 15
SHARPNESS = 8.0
BLOCK = 256

# --------------------------------------------------------------- features

_SIGNS = b".,!?;:*&%$#|-_/\\()[]{}<>=+@'\"~^"
_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _HIGH, _REST = range(1, 8)


def _shape_table() -> bytes:
    out = bytearray([_REST] * 256)
    for c in range(128, 256):
        out[c] = _HIGH
    for c in b"abcdefghijklmnopqrstuvwxyz":
        out[c] = _LOWER
    for c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
        out[c] = _UPPER
    for c in b"0123456789":
        out[c] = _DIGIT
    for c in b" \t\r\x0b\x0c":
        out[c] = _SPACE
    out[ord("\n")] = _LINE
    for i, c in enumerate(_SIGNS):
        out[c] = 8 + i
    return bytes(out)


_SHAPE = _shape_table()
_SHAPES = 8 + len(_SIGNS)
#: Bucket of each shape trigram, by a fixed multiplicative hash.
_BUCKET_OF = ((np.arange(_SHAPES**3, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(BUCKETS)).astype(np.int64)
STATS = 12


def statistics(text: str) -> list[float]:
    """Whole-text statistics between 0 and 1."""
    n = len(text)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    if not words:
        return [0.0] * STATS
    m = len(words)
    distinct, pairs = len(set(words)), len(set(zip(words, words[1:], strict=False)))
    tail = words[m // 2 :]
    letters = sum(map(str.isalpha, words))
    return [
        distinct / m,
        1 - distinct / m if m > 20 else 0.0,
        pairs / max(1, m - 1),
        1 - pairs / max(1, m - 1),
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / m,
        len(set(tail)) / len(tail),
        1 - len(set(lines)) / max(1, len(lines)),
        letters / m,
        sum(map(str.isupper, words)) / m,
        min(1.0, n / m / 20),
        min(1.0, np.log1p(m) / 10),
        min(1.0, len(lines) / m),
    ]


def features(text: str) -> np.ndarray:
    """Square-rooted shares of the shape trigrams of the whole text, then the statistics."""
    codes = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_SHAPE), np.uint8).astype(np.int32)
    counts = np.zeros(BUCKETS, np.float32)
    if len(codes) >= 3:
        grams = np.bincount((codes[:-2] * _SHAPES + codes[1:-1]) * _SHAPES + codes[2:], minlength=_SHAPES**3)
        used = np.flatnonzero(grams)
        np.add.at(counts, _BUCKET_OF[used], grams[used].astype(np.float32))
        counts = np.sqrt(counts / (len(codes) - 2))
    return np.concatenate([counts, np.array(statistics(text), np.float32)])


# --------------------------------------------------------------- model

@dataclass
class Model:
    """Latent space and labelled vectors; about ``2 * SAMPLE_PER_LABEL * DIMENSIONS`` floats."""

    weight: np.ndarray
    centre: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, rows: np.ndarray) -> np.ndarray:
        latent = (rows * self.weight - self.centre) @ self.basis
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Weighted vote of the nearest labelled vectors, 0 to 1; the prior is one weak vote."""
        out = np.full(len(rows), self.prior)
        k = min(NEIGHBOURS, len(self.vectors))
        for i in range(0, len(rows) if k else 0, BLOCK):
            cosines = self.project(rows[i : i + BLOCK]) @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weights = np.maximum(np.take_along_axis(cosines, near, 1), 0.0).astype(np.float64) ** SHARPNESS
            votes = (weights * self.labels[near]).sum(1)
            out[i : i + BLOCK] = (votes + 0.01 * self.prior) / (weights.sum(1) + 0.01)
        return out


def fit(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Latent space by truncated SVD of the weighted features, and the labelled vectors in it."""
    width = BUCKETS + STATS
    if not len(rows):
        zero = np.zeros((0, width), np.float32)
        return Model(np.ones(width, np.float32), np.zeros(width, np.float32), np.zeros((width, 1), np.float32), zero[:, :1], np.zeros(0), 0.5)
    spread = rows.std(0)
    # The statistics count in full, trigrams by the inverse of how evenly they appear everywhere.
    weight = (1.0 / np.maximum(spread, 0.02)).astype(np.float32)
    weight[:BUCKETS] *= 0.25
    centre = (rows * weight).mean(0)
    _, _, axes = np.linalg.svd(rows * weight - centre, full_matrices=False)
    basis = np.ascontiguousarray(axes[:DIMENSIONS].T).astype(np.float32)
    model = Model(weight, centre.astype(np.float32), basis, np.zeros((0, 1)), labels.astype(np.float64), float(labels.mean()))
    model.vectors = model.project(rows).astype(np.float32)
    return model


# --------------------------------------------------------------- Spark

def held_out(id_column: str = "doc_id") -> Column:
    """Rows kept out of training: crc32 of the id as text leaves 1 when divided by 3 (a null id is not held out)."""
    crc = F.crc32(id_col(id_column).cast("string").cast("binary"))
    return F.coalesce(crc % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", per_label: int = SAMPLE_PER_LABEL) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``per_label`` training rows of each label, those with the smallest id hashes.

    A document labelled more than once counts once, by its mean label, and an
    id with several texts by the first of them in text order; labels
    other than 0 and 1, null ids and ids without a document are left out.
    """
    spark = docs.sparkSession
    marked = (
        labels.select(id_col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("id"))
        .groupBy("id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )
    key = F.xxhash64("id")
    ids = []
    for value in (0, 1):
        rows = hash_sample(marked.filter(F.col("label") == value), key, per_label, 4)
        ids += rows.orderBy(key, "id").limit(per_label).collect()
    chosen = spark.createDataFrame([(r["id"], r["label"]) for r in ids], "id long, label int")
    # At most 2 * per_label ids: small enough to send to every task.
    rows = docs.select(id_col(id_column).alias("id"), text_or_empty(text_column).alias("text")).join(F.broadcast(chosen), "id")

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "x": [features(t).tobytes() for t in batch["text"]]})

    # One row per id, whatever the number of documents that repeat it: the first of its texts in order.
    one = rows.groupBy("id", "label").agg(F.min("text").alias("text"))
    got = sorted(one.mapInPandas(describe, "id long, label int, x binary").collect())
    x = np.array([np.frombuffer(r["x"], np.float32) for r in got], np.float32).reshape(len(got), BUCKETS + STATS)
    return x, np.array([r["label"] for r in got], np.int64)


def train(docs: DataFrame, labels: DataFrame, **columns) -> Model:
    return fit(*labelled_sample(docs, labels, **columns))


def score_column(docs: DataFrame, model: Model, text_column: str = "text") -> Column:
    """Score of every whole text as a column; null texts score as empty ones."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = sent.value
        for batch in batches:
            out = [np.zeros(0)]
            for i in range(0, len(batch), BLOCK):
                out.append(own.score(np.array([features(t) for t in batch.iloc[i : i + BLOCK]], np.float32)))
            yield pd.Series(np.concatenate(out))

    return F.pandas_udf(run, "double")(text_or_empty(text_column))


def score_documents(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, in one narrow pass.

    Scores lie between 0 and 1, higher for good texts; empty and null texts
    get the score of the empty text.  Without labelled rows every score is
    0.5.  Null ids are kept; repeated rows are scored as rows; an empty table
    gives an empty result.  Only the text is an input of a score.
    """
    model = model or train(docs, labels, id_column=id_column, text_column=text_column)
    scored = docs.select(
        id_col(id_column).alias("doc_id"), held_out(id_column).alias("held_out"), score_column(docs, model, text_column).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: Model | None = None) -> DataFrame:
    """The rows of ``docs`` that are not rejected (score at least 0.5), with all their columns."""
    model = model or train(docs, labels, id_column=id_column, text_column=text_column)
    scored = docs.withColumn(f"{OWN}score", score_column(docs, model, text_column))
    return scored.filter(F.col(f"{OWN}score") >= 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])
