"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import saved

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of
    ``links`` (a, b).

    Each round gives a node the smallest label next to it, then the label of
    its label, so long chains shorten by jumps.  Labels are written every
    round.  Hot nodes: minima are pre-aggregated, and the joins read two plain
    tables, which AQE splits."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v")
    edges = saved(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "cc-edges")
    labels = saved(edges.groupBy("u").agg(F.min("v").alias("m"))
                   .select(F.col("u").alias("node"), F.least("u", "m").alias("component")), "cc-labels")
    for _ in range(MAX_ROUNDS):
        near = (edges.join(labels.select(F.col("node").alias("v"), "component"), "v")
                .groupBy("u").agg(F.min("component").alias("m")))
        moved = saved(labels.join(near.withColumnRenamed("u", "node"), "node", "left")
                      .select("node", F.col("component").alias("old"), F.least("component", F.coalesce("m", "component")).alias("component")),
                      "cc-moved")
        parents = moved.select(F.col("node").alias("component"), F.col("component").alias("up"))
        after = saved(moved.join(parents, "component").select("node", "old", F.col("up").alias("component")), "cc-labels")
        labels = after.select("node", "component")
        if after.filter("component <> old").isEmpty():
            return labels
    raise RuntimeError("components did not settle")
