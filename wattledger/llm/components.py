"""Connected components of an edge table, by rounds of joins on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattledger.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of the nodes of (a, b): the label is the least node reached.

    A round gives every node the least label around it and then that label's own label,
    so paths shorten by more than half. Labels only fall, and the rounds end when none
    does. Nothing but the number of changed labels comes to the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    both = stored(both.distinct().toDF("node", "other"), "edges")
    labels = stored(
        both.groupBy("node").agg(F.min("other").alias("least")).select(
            "node", F.least("node", "least").alias("label")
        ),
        "labels",
    )
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("other"), "label"), "other")
            .groupBy("node")
            .agg(F.min("label").alias("least"))
        )
        lower = labels.join(around, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "least").alias("label")
        )
        lower = stored(lower, "labels-lower")
        jump = lower.select(F.col("node").alias("at"), F.col("label").alias("beyond"))
        new = stored(
            lower.join(jump, F.col("label") == F.col("at")).select(
                "node", F.col("beyond").alias("label"), (F.col("beyond") != F.col("old")).alias("changed")
            ),
            "labels",
        )
        labels = new.select("node", "label")
        if new.filter("changed").isEmpty():
            return labels
