"""Connected components of an edge table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import Workspace


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """`node` and `label`, the smallest node of its component, from edges (a, b).

    Each round takes the least label around a node, then the label of that
    label, so chains halve; every round is a written table. A hub's labels are
    combined map-side, and its join is one that adaptive execution can split.
    """
    one = edges.where("a != b").distinct()
    both = work.save(one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = work.save(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        known = labels.select(F.col("node").alias("b"), F.col("label").alias("far"))
        around = both.join(known, "b").groupBy(F.col("a").alias("node")).agg(F.min("far").alias("near"))
        least = labels.join(around, "node").select("node", "label", F.least("label", "near").alias("best"))
        jump = labels.select(F.col("node").alias("best"), F.col("label").alias("beyond"))
        moved = least.join(jump, "best").select(
            "node", F.least("best", "beyond").alias("label"), (F.least("best", "beyond") != F.col("label")).alias("moved")
        )
        moved = work.save(moved, "labels")
        labels = moved.drop("moved")
        if not moved.where("moved").limit(1).count():
            return labels
