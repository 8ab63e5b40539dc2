"""Connected components of a graph given as edges, by alternating large and small stars.

Every round replaces the edges by others of the same components, at most as many, until each node hangs on the
smallest node of its component. A node with very many neighbours is aggregated before the shuffle and its edges
may be split over tasks, since the other side of that join has one row per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def _checked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    written = materialise(edges.distinct(), "edges")
    seen = written.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return written, tuple(seen)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that has an edge to another; root is the smallest node of the component."""
    edges, seen = _checked(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v"))
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, now = _checked(small.union(least.select("u", F.col("m").alias("v"))))
        if now == seen:
            break
        seen = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
