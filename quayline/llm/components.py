"""Connected components of an edge table, with every step kept in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayline.session import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for each node of ``edges(u, v)``; the label is the component's smallest node.

    Each round takes the smallest label around a node and then follows the label
    one step, so long chains shorten by doubling. A round is written to the
    shared folder, which cuts lineage and outlives lost executors. No edges: no rows.
    """
    spark = edges.sparkSession
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v")
    both = staged(spark, both.distinct(), "edges")
    labels = staged(
        spark, both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("node")).alias("label")), "labels"
    )
    while True:
        around = (
            both.join(labels.withColumnRenamed("node", "v"), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        closer = labels.join(around, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        closer = staged(spark, closer, "labels")
        # The label's own label: a node's label is a node of the same component.
        jump = closer.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = closer.join(jump, "label").select("node", "old", F.least("label", "further").alias("label"))
        labels = staged(spark, labels, "labels")
        changed = labels.where("label <> old").limit(1).count()
        labels = labels.select("node", "label")
        if not changed:
            return labels
