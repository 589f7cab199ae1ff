"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.operators.staging import staged


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the smallest node it can reach.

    Each round a node takes the smallest root among its neighbours, then the root of its root, so chains
    halve. Rounds are written tables in the shared folder; a round's counts of changes are all the driver sees.
    A node's degree is what the caller's edges give it; the root's root is a join of two written tables, where
    Spark splits a root that many nodes share. Edges may repeat; an empty table has no nodes.
    """
    both = staged(
        edges.select("a", "b").union(edges.select("b", "a")).filter("a is not null and b is not null").distinct()
    )
    labels = staged(
        both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("root"))
    )
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("low"))
        hooked = staged(
            labels.join(seen, labels["node"] == seen["a"], "left").select(
                "node", F.least("root", F.coalesce("low", "root")).alias("root"), F.col("root").alias("was")
            )
        )
        up = hooked.select(F.col("node").alias("up"), F.col("root").alias("top"))
        jumped = staged(
            hooked.join(up, hooked["root"] == up["up"], "left").select(
                "node", F.least("root", F.coalesce("top", "root")).alias("root"), "was"
            )
        )
        changed = jumped.filter("root < was").limit(1).count()
        labels = jumped.select("node", "root")
        if not changed:
            return labels
