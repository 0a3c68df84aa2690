"""Connected components of an edge table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockstat.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the least node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, move to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
        .union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node with an edge other than its own least.

    Alternating large and small stars; each round is written to the shared folder.
    Nodes absent from the result are their own component.
    """
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a <> b").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state.n == 0 or (state.n, state.x) == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = (state.n, state.x)
        edges = staged(_small_star(_large_star(edges).distinct()).distinct(), "edges")
