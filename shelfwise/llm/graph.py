"""Connected components of an edge table as a loop of joins and group-bys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import saved


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them (edges have a > b)."""
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    side = e.join(low, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return side.union(low.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the edges; component is the smallest node it reaches.

    Alternating large-star and small-star steps (Kiveris et al., 2014): the edge table never grows,
    rounds are logarithmic in the diameter, and each round is written to the shared folder. Nodes
    without an edge to another node do not appear. Null ends and loops are dropped. Raises when
    ``max_rounds`` do not suffice."""
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    e = edges.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
    e = saved(e.where(x.isNotNull() & y.isNotNull() & (F.col("a") != F.col("b"))).distinct())
    for _ in range(max_rounds):
        if _is_star_forest(e):
            roots = e.select(F.col("b").alias("node")).distinct()
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                roots.select("node", F.col("node").alias("component")))
        e = saved(_small_star(_large_star(e)).distinct())
    raise RuntimeError(f"components: not converged in {max_rounds} rounds")


def _is_star_forest(e: DataFrame) -> bool:
    """Whether every node with an edge to a smaller one has just that edge and no larger neighbour."""
    ends = e.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        e.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()
