"""Connected components of an edge table, as joins over a written table.

Each round every node takes the smallest label among itself and its neighbours, then
the label of its label. Both sides shrink only, so the rounds end; jumping over
labels keeps their number near the logarithm of the longest chain. Every round is
written to the shared folder, so lineage never grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.blocks import forget, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); the label is the smallest node."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a != b").dropDuplicates(), "edges")
    nodes = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label"))
    before = labels = stored(nodes, "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        grown = labels.join(near, F.col("node") == F.col("a")).select(
            "node", "label", F.least("label", "near").alias("next")
        )
        above = labels.select(F.col("node").alias("next"), F.col("label").alias("above"))
        jumped = grown.join(above, "next").select(
            "node", F.least("next", "above").alias("label"), (F.least("next", "above") != F.col("label")).alias("moved")
        )
        step = stored(jumped, "labels")
        forget(before)
        before, labels = step, step.drop("moved")
        if step.where("moved").isEmpty():
            forget(both)
            return labels
