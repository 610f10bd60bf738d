"""Connected components of a link table, by joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockrisk.llm.frames import written


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the least node that links reach.

    Each round every node takes the least label around it, then the label of its label, so paths
    shorten by more than half; a round is written out, which ends its lineage. Hubs cost no more
    than their links: labels meet in partial aggregates.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("near"))
    both = written(both.unionByName(both.select(F.col("near").alias("node"), F.col("node").alias("near"))).where("node != near"), "links")
    labels = written(both.groupBy("node").agg(F.least("node", F.min("near")).alias("label")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("near"), "label"), "near").groupBy("node").agg(F.min("label").alias("least"))
        hooked = labels.join(around, "node").select("node", F.col("label").alias("before"), F.least("label", "least").alias("hook"))
        over = labels.select(F.col("node").alias("hook"), F.col("label").alias("over"))
        step = written(hooked.join(over, "hook", "left").select("node", F.least("hook", "over").alias("label"), "before"), "labels")
        labels = step.select("node", "label")
        if step.where("label != before").isEmpty():
            return labels
