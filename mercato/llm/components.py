"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``; the root is the
    smallest node reachable (a root itself is listed too).

    Each step hangs neighbours on their smallest neighbour (first the larger ones,
    then the smaller ones), so a node's neighbours are never gathered: only a
    minimum per node is aggregated and joined back. Links are written after every
    round; the number of rounds follows the logarithm of the longest path.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a <> b").distinct())
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.join(least.select("a", F.least("a", "m").alias("m")), "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))))
        edges = written(small.where("a <> b").distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one node, which itself hangs on none."""
    ends = edges.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("a"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("a").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return ends.where("up > 1 or (up > 0 and down > 0)").isEmpty()
