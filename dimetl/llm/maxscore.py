"""Exact top-k search by MaxScore over integer vectors.

Vectors are seen as documents whose terms are the dimensions.  For a query,
dimension ``d`` adds ``q[d] * v[d]``, which is at most
``max(q[d] * hi[d], q[d] * lo[d])`` over a block with component range
``[lo, hi]``.  Dimensions are ordered by how far that bound lies above the
block's least possible addition; a suffix of weak dimensions whose spare
bounds together cannot lift a vector over the current k-th best score is
non-essential.  Essential dimensions are traversed for the whole block, the
others are probed only for vectors that are still competitive.  Every block
(shard) keeps its own top k of each query; the shards' lists are merged last.

The work is a grid: candidate shards x query blocks.  Each cell holds a
bounded number of rows whatever the table's size.  One shard is searched
first: a query's k-th best score there is a bar that its k best of all rows
reach, and every other cell starts from it.
"""

from __future__ import annotations

from heapq import nsmallest

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimetl.llm.common import materialise

K = 10
SHARD_ROWS = 8192
QUERY_ROWS = 16384
TILE = 1024
#: Float products are exact while every partial sum stays under 2**53.
_EXACT = 2.0**53


def integer_vectors(df: DataFrame, id_column: str, vector_column: str, scale: int = 1024) -> DataFrame:
    """``id, v``: components ``floor(scale * x)`` as array<long>; unusable vectors left out.

    A vector takes part if it is not null and no component is null, NaN or
    infinite; a scaled component that does not fit a long raises an error.  An
    empty vector takes part with score 0; vectors of different lengths meet as
    if padded with zeros.  Rows without an id are left out.  Repeated rows stay
    and rank as rows.
    """
    vec = F.col(f"`{vector_column}`")

    def usable(x: Column) -> Column:
        y = x.cast("double")
        return y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf"))

    def scaled(x: Column) -> Column:
        y = x.cast("double") * scale
        wide = F.raise_error(F.lit("a scaled component does not fit a long")).cast("long")
        return F.when(F.abs(y) < 2.0**63, F.floor(y)).otherwise(wide)

    return (
        df.select(F.col(f"`{id_column}`").cast("long").alias("id"), vec.alias("raw"))
        .filter(F.col("id").isNotNull() & F.col("raw").isNotNull())
        .filter(F.forall("raw", usable))
        .select("id", F.transform("raw", scaled).alias("v"))
    )


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.float64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def split_terms(spare: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Essential and non-essential dimensions, given the spare bound of each.

    A vector that misses all the spare bounds of the essential dimensions must
    reach ``slack`` with the others; the largest set of weak dimensions that
    cannot is non-essential.
    """
    order = np.argsort(spare, kind="stable")
    weak = int(np.searchsorted(np.cumsum(spare[order]), slack, side="left"))
    return order[weak:], order[:weak]


def search_block(
    q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int, tile: int = TILE, bars: np.ndarray | None = None
) -> list[tuple[int, int, int]]:
    """``(query id, id, score)``: the k best other rows of a shard for each query, ties to smaller ids.

    Rows with a score under the query's bar may be left out; without bars none are.
    """
    bars = np.full(len(q), -np.inf) if bars is None else bars
    by_id = np.argsort(ids, kind="stable")
    ids, v = ids[by_id], v[by_id]
    out = []
    tiles = [(ids[i : i + tile], v[i : i + tile], v[i : i + tile].min(0), v[i : i + tile].max(0)) for i in range(0, len(ids), tile)]
    for q_id, x, least in zip(q_ids.tolist(), q, bars.tolist(), strict=True):
        best_ids, best = np.empty(0, np.int64), np.empty(0)
        for t_ids, t, lo, hi in tiles:
            low, high = np.minimum(x * lo, x * hi), np.maximum(x * lo, x * hi)
            floor_sum, spare = low.sum(), high - low
            bar = max(best[-1], least) if len(best) == k else least
            if floor_sum + spare.sum() < bar:
                continue
            essential, weak = split_terms(spare, bar - floor_sum)
            part = t[:, essential] @ x[essential]
            alive = np.flatnonzero((t_ids != q_id) & (part + high[weak].sum() >= bar))
            scores = part[alive]
            # Probe the non-essential dimensions from the strongest down, in a few strides.
            for cut in np.array_split(weak[::-1], 4) if len(weak) else ():
                scores = scores + t[np.ix_(alive, cut)] @ x[cut]
                weak = weak[: len(weak) - len(cut)]
                still = scores + high[weak].sum() >= bar
                alive, scores = alive[still], scores[still]
            got_ids, got = np.concatenate([best_ids, t_ids[alive]]), np.concatenate([best, scores])
            top = np.lexsort((got_ids, -got))[:k]
            best_ids, best = got_ids[top], got[top]
        out += zip([q_id] * len(best), best_ids.tolist(), best.astype(np.int64).tolist(), strict=True)
    return out


def search_wide(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """As ``search_block``, for components whose products floats do not hold: integers of any size, all pairs."""
    out = []
    if not len(q_ids) or not len(ids):
        return out
    q, v = (x.astype(np.int64).astype(object) for x in (q, v))
    for q_id, x in zip(q_ids.tolist(), q, strict=True):
        used = np.flatnonzero(x)
        scores = (v[:, used] @ x[used]).tolist() if len(used) else [0] * len(ids)
        found = nsmallest(k, ((-s, i) for s, i in zip(scores, ids.tolist(), strict=True) if i != q_id))
        if any(not -(2**63) <= -s < 2**63 for s, _ in found):
            raise OverflowError(f"a score of query {q_id} does not fit a long")
        out += [(q_id, i, -s) for s, i in found]
    return out


def _cell(k: int):
    def run(queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(queries) or not len(shard):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in columns})
        width = max(queries["v"].map(len).max(), shard["v"].map(len).max())
        # Every component is the floor of a double, so that doubles hold it exactly, however large.
        q, v = matrix(queries["v"], width), matrix(shard["v"], width)
        q_ids, ids = queries["id"].to_numpy(), shard["id"].to_numpy()
        most = (_EXACT / max(width, 1)) ** 0.5
        q_small, v_small = np.abs(q).max(1, initial=0) < most, np.abs(v).max(1, initial=0) < most
        rows = []
        if q_small.any() and v_small.any():
            bars = queries["bar"].to_numpy(np.float64, na_value=-np.inf)
            # A bar too large for a float to hold is rounded; one step lower it is a bar still.
            bars = np.where(np.abs(bars) < _EXACT, bars, np.nextafter(bars, -np.inf))
            rows += search_block(q_ids[q_small], q[q_small], ids[v_small], v[v_small], k, bars=bars[q_small])
        rows += search_wide(q_ids[q_small], q[q_small], ids[~v_small], v[~v_small], k)
        rows += search_wide(q_ids[~q_small], q[~q_small], ids, v, k)
        return pd.DataFrame(rows, columns=columns).astype("int64")

    return run


def _search(asked: DataFrame, dealt: DataFrame, blocks: int, first: int, last: int, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the k best of every cell of the shards ``first`` to ``last`` and the query blocks."""
    cells = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(first), F.lit(last))))
    return (
        asked.groupBy("shard", "block")
        .cogroup(cells.groupBy("shard", "block"))
        .applyInPandas(_cell(k), "query_id long, vec_id long, score long")
    )


def top_k(
    queries: DataFrame, vectors: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest inner products of every query.

    Both frames are ``id, v`` as ``integer_vectors`` returns them.  A query's
    own id is no candidate; ties go to the smaller id; fewer than k rows come
    back where fewer candidates exist, none on empty tables.  Queries that
    repeat an id rank once, by the smallest of their vectors; repeated candidate
    rows rank as rows.
    """
    # Of vectors that share a query's id the smallest asks, so that a task that runs again asks alike.
    once = queries.groupBy("id").agg(F.min("v").alias("v"))
    # The written row numbers deal repeated ids alike in both searches, however their scans are split.
    vectors = materialise(vectors.select("id", "v", F.monotonically_increasing_id().alias("n")), "maxscore-vectors")
    asked = materialise(once, "maxscore-queries")
    shards, blocks = -(-vectors.count() // shard_rows) or 1, -(-asked.count() // query_rows) or 1
    # Row numbers by hash spread any order of the input; every shard has every range of ids and scores.
    dealt = vectors.select("id", "v", F.pmod(F.xxhash64("id", "n"), F.lit(shards)).cast("int").alias("shard"))
    asked = asked.withColumns({"block": F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"), "bar": F.lit(None).cast("double")})
    found = _search(asked, dealt.filter(F.col("shard") == 0), blocks, 0, 0, k)
    if shards > 1:
        found = materialise(found, "maxscore-sample")
        reached = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("least"))
        bars = reached.select(F.col("query_id").alias("id"), F.when(F.col("n") >= k, F.col("least")).alias("bar"))
        barred = materialise(asked.drop("bar").join(bars, "id", "left"), "maxscore-bars")
        found = found.unionByName(_search(barred, dealt.filter(F.col("shard") > 0), blocks, 1, shards - 1, k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v, true), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON c.vec_id <> q.vec_id
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT query_id, vec_id, score,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
