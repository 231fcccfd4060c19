"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import drop_written, written


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable from every node of ``edges(a, b)``.

    Alternating stars: the large star links every larger neighbour of a node to
    the node's smallest neighbour, the small star does the same for the smaller
    ones.  After O(log^2) rounds each component is one star around its smallest
    node.  Only (node, node) rows move, minima are pre-aggregated before the
    shuffle, and a node with very many edges is only ever joined, which adaptive
    execution splits.  Every round is a written table.  Nodes without an edge
    (or with an edge to itself only) are not returned.
    """
    star = written(edges.where("a <> b").selectExpr("greatest(a, b) a", "least(a, b) b").distinct(), "edges")
    if star.isEmpty():
        return star.selectExpr("a node", "b comp")
    while True:
        both = star.union(star.selectExpr("b a", "a b"))
        low = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("m"))
        large = both.where("b > a").join(low.hint("merge"), F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a <> b").distinct(), "large")
        low = large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        small = large.join(low.hint("merge"), F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.where("a <> b").union(low.selectExpr("node a", "m b"))
        after = written(small.distinct(), "small")
        drop_written(large)
        drop_written(star)
        star = after
        if _stars(star):
            return star.selectExpr("a node", "b comp")


def _stars(edges: DataFrame) -> bool:
    """Whether every node of edges(a, b), distinct and a > b, is either a centre or has one edge, to a centre."""
    ends = edges.selectExpr("a node", "1L up", "0L down").union(edges.selectExpr("b node", "0L up", "1L down"))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()
