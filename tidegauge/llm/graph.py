"""Connected components by repeated minimum labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.store import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component: its smallest node.

    Each round takes the smallest label around a node, then jumps to the label of that label,
    so the number of rounds grows with the logarithm of a chain's length. Labels are combined
    before each shuffle, so a star with very many leaves is one row per task.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("near"))
    both = checkpointed(both.unionByName(both.select(F.col("near").alias("node"), F.col("node").alias("near"))).filter("node <> near").distinct())
    labels = checkpointed(both.groupBy("node").agg(F.least(F.col("node"), F.min("near")).alias("component")))
    while True:
        seen = labels.select(F.col("node").alias("near"), F.col("component").alias("c"))
        around = both.join(seen, "near").groupBy("node").agg(F.min("c").alias("c"))
        lower = labels.join(around, "node").select("node", F.least("component", "c").alias("component"), F.col("component").alias("old"))
        heads = labels.select(F.col("node").alias("component"), F.col("component").alias("head"))
        jumped = lower.join(heads, "component", "left")
        after = checkpointed(jumped.select("node", F.least("component", "head").alias("component"), "old"))
        labels = after.select("node", "component")
        if after.filter("component <> old").isEmpty():
            return labels
