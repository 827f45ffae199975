"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuration.runtime import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to the least of the node and its neighbours."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return around.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
        .where(F.col("a") != F.col("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()


def components(edges: DataFrame) -> DataFrame:
    """node, component: for each node of an edge (a, b) the least node reachable from it.

    Alternating large and small stars (Kiveris et al. 2014): a logarithmic number of
    rounds in practice, each a few joins on the edges; a hub's edges are split by AQE.
    """
    edges = materialize(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "edges")
    state = _state(edges)
    while True:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        state, before = _state(edges), state
        if state == before:
            break
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionAll(roots)
