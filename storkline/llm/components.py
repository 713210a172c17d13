"""Connected components of a graph kept in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storkline.session import stored


def connected_components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; a component is named by its least node.

    Each round a node takes the least label among its neighbours, then the label of its label, so
    distances shrink by more than half. Labels are written to the shared folder after every step, which
    cuts the lineage. A node with very many links meets its own label in a join whose large partitions
    adaptive execution splits; labels are reduced before they are shuffled.
    """
    known = links.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    both = known.select("a", "b").unionAll(known.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both, "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    for _ in range(max_rounds):
        sent = edges.join(labels, F.col("a") == F.col("node")).groupBy(F.col("b").alias("node"))
        least = sent.agg(F.min("label").alias("_near"))
        near = labels.join(least, "node").select("node", F.least("label", "_near").alias("label"), F.col("label").alias("_old"))
        near = stored(near, "near")
        if near.filter(F.col("label") != F.col("_old")).isEmpty():
            return labels.select("node", F.col("label").alias("component"))
        target = near.select(F.col("node").alias("_to"), F.col("label").alias("_next"))
        labels = stored(
            near.join(target, F.col("label") == F.col("_to")).select("node", F.least("label", "_next").alias("label")),
            "labels",
        )
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
