"""Connected components by alternating large-star and small-star steps.

Each step is one aggregation and one join keyed by node; the driver sees two
numbers a round (a count and a checksum).  Steps go on until nothing changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.store import stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.least("a", "m").alias("a"), "b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Edges come as a < b: every larger end points all its smaller neighbours and itself to the smallest."""
    least = e.groupBy("b").agg(F.min("a").alias("m"))
    other = e.join(least, "b").filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return other.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has an edge: component is its smallest reachable node.  Nulls and loops are ignored."""
    e = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct()
    e, seen = stored(e, "edges"), None
    while True:
        e = stored(_small_star(_large_star(e)), "edges")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen or now[0] == 0:
            break
        seen = now
    roots = e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return e.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)
