"""Connected components over DataFrames by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimetl.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node moves to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select("b", "a").toDF("a", "b"))
    smallest = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "components-large")
    return (
        both.join(smallest, "a")
        .filter("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them (edges point from larger to smaller)."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    smallest = materialise(down.groupBy("a").agg(F.min("b").alias("m")), "components-small")
    moved = down.join(smallest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(smallest.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) of every node that has an edge ``a, b``.

    Every round is written to the shared scratch folder, so a lost executor
    costs one round at most.  A node's neighbours are only ever reduced to
    their minimum (partial aggregation first), and the minimum joins back on a
    plain exchange that AQE can split at a hot node; no list of neighbours is
    built.  Self links and repeated links are fine; no edges give no rows.
    """
    edges = materialise(edges.filter("a <> b").select("a", "b").distinct(), "components")
    before = _state(edges)
    while before[0]:
        edges = materialise(_small_star(_large_star(edges)), "components")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
