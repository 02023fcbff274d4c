"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspan.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in `edges` (a, b): root is the smallest node of its component, and its own.

    Each round writes its edges, so lineage stays short; rounds grow with the logarithm of a component's size. Only counts
    reach the driver."""
    now = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    while _unfinished(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(large, "edges")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialise(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _unfinished(edges: DataFrame) -> bool:
    """Whether some node has two roots, or a root that has a root."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above"))
    )
    counts = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return not counts.where((F.col("below") > 1) | ((F.col("below") > 0) & (F.col("above") > 0))).isEmpty()
