"""Connected components of an edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.sources.scratch import discard, stage


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, label`` for every node that has an edge; the label is the smallest node reachable.

    Each round a node takes the smallest label among its neighbours and then the label of
    that label, so chains shorten fast. Labels are aggregated before they are joined, and
    every round is written to the shared scratch folder, so lineage stays short; the round before
    is removed when the next one stands.
    """
    both = edges.select(F.col(left).alias("node"), F.col(right).alias("to"))
    both = both.unionByName(both.select(F.col("to").alias("node"), F.col("node").alias("to"))).distinct()
    both = stage(both, "edges")
    labels = held = stage(
        both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("label")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("to"), "label"), "to")
            .groupBy("node")
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("next"))
        moved = lower.join(jump, "new", "left").select(
            "node",
            F.least("new", "next").alias("label"),
            (F.least("new", "next") != F.col("label")).alias("changed"),
        )
        moved = stage(moved, "labels")
        discard(held)
        labels, held = moved.select("node", "label"), moved
        if not moved.where("changed").limit(1).count():
            discard(both)
            return labels
