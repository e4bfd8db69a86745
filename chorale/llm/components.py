"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u and v <> m").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    return joined.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a <> b").union(joined.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) to one row (node, root) per node that has an edge; the root is the least node reachable.

    Loops and edges in either direction are allowed.  Each round is checkpointed in the shared folder; only a count and a
    checksum of the edges reach the driver.  Rounds go on until nothing changes, which takes about the logarithm of the largest
    component's size.
    """
    ends = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    current = checkpointed(ends)
    seen = None
    while True:
        mark = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        current = checkpointed(_small_star(_large_star(current)))
    # At the fixed point every edge leads from the least node of its component.
    roots = current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return current.select(F.col("b").alias("node"), F.col("a").alias("root")).union(roots)
