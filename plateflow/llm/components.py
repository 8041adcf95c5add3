"""Connected components of a graph that is given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateflow.llm.common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``edges (a, b)``; the root is the component's least node.

    Large-star and small-star steps alternate (Kiveris et al., SOCC 2014).  Both join edges with the
    least neighbour of a node, which is pre-aggregated, so a node with very many edges is split by
    adaptive execution.  Each round is written to the shared folder; a lost executor costs one round.
    The number of rounds grows with the logarithm of the number of nodes.
    """
    edges = materialise(_oriented(edges), "edges")
    state = _fingerprint(edges)
    while True:
        edges = materialise(_small_star(_large_star(edges)), "edges")
        state, before = _fingerprint(edges), state
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b"), F.col("b")).distinct()
            )


def _fingerprint(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from the greater node ``a`` to the lesser ``b``."""
    return (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a > b")
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's greater neighbours with the least node around it."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    joined = both.join(least, "a").filter("b > a")
    return joined.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its lesser neighbours with the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(
        F.when(F.col("b") == F.col("least"), F.col("a")).otherwise(F.col("b")).alias("a"),
        F.col("least").alias("b"),
    )
    return moved.distinct()
