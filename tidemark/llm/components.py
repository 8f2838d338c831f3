"""Connected components of a table of links, by min-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root`` for every node of the links: the smallest node that its links lead to.

    Each round links every node to the smallest label around it, and then follows that label
    one step (labels are nodes): path lengths fall by half or more. Every round's labels are
    written to the shared folder, and the loop ends when no label changes. Only a number of
    changed rows reaches the driver. The label of a node with very many links is a sum with
    map-side partial results, and the joins can be split by AQE, as both sides are shuffled.
    """
    pairs = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).where(F.col("node") != F.col("other"))
    both = pairs.unionByName(pairs.select(F.col("other").alias("node"), F.col("node").alias("other")))
    both = stored(both.distinct(), "links")
    label = both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("root"))
    label = stored(label, "labels")
    while True:
        near = both.join(label.select(F.col("node").alias("other"), "root"), "other").select("node", "root")
        least = near.unionByName(label).groupBy("node").agg(F.min("root").alias("root"))
        # The label of the label: roots are nodes too.
        jumped = stored(least, "labels").alias("l")
        up = jumped.select(F.col("node").alias("up"), F.col("root").alias("top"))
        jumped = jumped.join(up, F.col("l.root") == F.col("up"), "left").select(
            F.col("l.node").alias("node"), F.least("l.root", F.coalesce("top", "l.root")).alias("root")
        )
        new = stored(jumped, "labels")
        old = label.select("node", F.col("root").alias("was"))
        changed = new.join(old, "node").where(F.col("root") != F.col("was")).limit(1).count()
        label = new
        if not changed:
            return label
