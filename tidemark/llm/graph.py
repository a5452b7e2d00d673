"""Connected components by iterative Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node in ``edges``: label is the smallest node of its component.

    Each round takes the smallest label among the neighbours and then that
    label's own label (pointer jumping), until nothing changes. Rounds are
    written to the shared folder; only a count of changed rows reaches the driver.
    """
    both = materialize(
        edges.select(F.col(a).alias("a"), F.col(b).alias("b")).union(edges.select(F.col(b), F.col(a)))
        .filter("a <> b").distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        stepped = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("step"))
        jump = labels.select(F.col("node").alias("step"), F.col("label").alias("jump"))
        fresh = materialize(
            stepped.join(jump, "step").select("node", F.least("step", "jump").alias("label"),
                                              (F.least("step", "jump") < F.col("label")).alias("moved")), "labels")
        labels = fresh.select("node", "label")
        if fresh.filter("moved").isEmpty():
            return labels
