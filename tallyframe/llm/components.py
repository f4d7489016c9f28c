"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.staging import stage


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of all nodes in ``links(a, b)``: the least node they reach.

    Every round takes the least label among the neighbours and then that
    label's own label, so a path shortens by half; rounds end when nothing
    changes. Labels are staged per round; the driver sees one count.
    """
    both = stage(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "node").withColumn("least", F.least("component", "near"))
        own = labels.select(F.col("node").alias("least"), F.col("component").alias("further"))
        moved = stage(
            lower.join(own, "least").select(
                "node",
                F.least("least", "further").alias("component"),
                (F.least("least", "further") < F.col("component")).alias("changed"),
            ),
            "labels",
        )
        labels = moved.select("node", "component")
        if moved.where("changed").isEmpty():
            return labels
