"""Connected components by label propagation with pointer jumping, on frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """For edges (a, b) of two longs: one row (node, label) per node, label being the least node reachable.

    In each round a node takes the least label beside it, then the label of its label; labels thus reach twice
    as far per round. Minima are taken before the shuffle, so a node with very many edges costs one row
    per task; each round's labels are staged, and only a count of changes reaches the driver.
    """
    both = stage(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = stage(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        beside = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        best = labels.join(beside.withColumnRenamed("a", "node"), "node").select(
            "node", "label", F.least("label", "near").alias("near")
        )
        further = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        moved = stage(best.join(further, "near").select("node", F.col("far").alias("label"), (F.col("far") != F.col("label")).alias("moved")), "labels")
        labels = moved.select("node", "label")
        if moved.filter("moved").isEmpty():
            return labels
