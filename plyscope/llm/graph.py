"""Connected components of an edge table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope.llm.common import written


def _toward_least(edges: DataFrame, smaller_only: bool) -> DataFrame:
    """One star step on edges (a > b): every node's neighbours are hung on its least neighbour."""
    both = edges if smaller_only else edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("m"))
    joined = both.join(least, both["a"] == least["node"])
    if smaller_only:
        out = joined.select(F.col("b").alias("x"), "m").unionByName(least.select(F.col("node").alias("x"), "m"))
    else:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("x"), "m")
    return out.filter(F.col("x") != F.col("m")).select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each node of the edges (a > b, distinct) hangs on one node at most, which hangs on none: a round would
    change nothing then. One aggregate, where seeing it from a round takes that round's joins."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.filter("up > 1 or (up > 0 and down > 0)").count()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label): the least node id reachable, for every node that has an edge.

    ``edges`` has long columns a and b. Alternates large-star and small-star steps until nothing
    would change; a node with very many neighbours is only ever min-aggregated and joined, never gathered.
    Each round is written to the shared folder. Raises if ``max_rounds`` do not suffice."""
    cur = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(max_rounds):
        if _stars(cur):
            node = cur.select(F.col("a").alias("node"), F.col("b").alias("label"))
            return node.unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        cur = written(_toward_least(_toward_least(cur, False), True))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
