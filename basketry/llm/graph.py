"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over links (a, b), itself included.

    Each round a node takes the smallest label among its neighbours and then its label's
    label; labels are written as a table after each round. Neighbours' labels are combined
    per task before they meet, so a node with very many links is one row per task. Long
    chains shrink by pointer jumping, so rounds grow with the logarithm of their length.
    """
    both = links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    both = materialize(both.where("a <> b").distinct(), "links", tidy=True)
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.col("node")).alias("label")), "labels", tidy=True)
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        nearer = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        nearer = materialize(nearer, "labels", tidy=True)
        jump = nearer.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        moved = nearer.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("beyond", "label")).alias("label")
        )
        moved = materialize(moved, "labels", tidy=True)
        labels = moved.select("node", "label")
        if not moved.where("label <> old").limit(1).count():
            return labels
