"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from leadspark.session import keep


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)``: each node of the edges ``(a, b)`` with the least node that it can reach.

    Least labels spread along the edges, and each label then takes its own label, so that paths halve. Every step
    is aggregated before its shuffle and written to the shared folder; a hub with many edges is one row per task.
    """
    ways = keep(edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct())
    labels = keep(ways.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = (
            ways.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        spread = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("jump"))
        stepped = keep(spread.join(jump, "low", "left").select("node", F.col("label").alias("was"), F.least("low", "jump").alias("label")))
        labels = stepped.select("node", "label")
        if not stepped.where("was != label").limit(1).count():
            return labels
