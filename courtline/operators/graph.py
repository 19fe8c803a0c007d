"""Connected components by min-label propagation (iterative, distributed).

Used to split the Elo pass into independent player pools: players who never
met (directly or through others) cannot influence each other's ratings, so
rating each component separately gives the same numbers with more tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.session import ensure_checkpoint_dir


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst",
                         checkpoint_every: int = 4) -> DataFrame:
    """(node, component): component = smallest node id connected to the node.

    Each round sends every node's label to its neighbours and keeps the
    minimum: one join and one aggregation, both keyed by node.  The driver
    only sees the number of labels that changed.  Lineage is cut every few
    rounds with ``checkpoint()`` into the shared checkpoint folder.  Rounds go
    on until no label changes, however long the longest path is.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter(
        F.col("a").isNotNull() & F.col("b").isNotNull())
    und = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    und = und.repartition("a").checkpoint()
    labels = und.select(F.col("a").alias("node")).distinct().withColumn("comp", F.col("node"))
    i = 0
    while True:
        i += 1
        sent = und.join(labels, und["a"] == labels["node"]).select(
            F.col("b").alias("node"), F.col("comp"))
        new = labels.unionByName(sent).groupBy("node").agg(F.min("comp").alias("comp"))
        if i % checkpoint_every == 0:
            new = new.checkpoint()
        changed = (new.alias("n").join(labels.alias("o"), "node")
                   .filter(F.col("n.comp") != F.col("o.comp")).limit(1).count())
        labels = new
        if changed == 0:
            return labels
