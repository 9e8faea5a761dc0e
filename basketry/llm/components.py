"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is an aggregation (minimum per node, combined before the shuffle) and a join, so a node
with very many edges is never gathered in one task. The table of edges is written after each
round; only two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"),
                                                        F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"),
                                                          F.col("m").alias("b"))
    return moved.union(least.toDF("a", "b"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` has two columns of one ordered type; returns (node, root) for every node that
    is not the least of its component. Loops, repeats and both directions are allowed; an edge
    with a null end is ignored."""
    now = shared_table(edges.toDF("a", "b").filter("a <> b").distinct(), "edges")
    mark = None
    while True:
        now = shared_table(_small_star(_large_star(now)).filter("a <> b").distinct(), "stars")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.toDF("node", "root")
        mark = seen
