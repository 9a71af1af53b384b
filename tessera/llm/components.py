"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``node, label`` (smallest node reachable) of every node in ``links`` (``a, b``).

    Each round takes the smallest label among a node's neighbours and then the label of
    that label; tables are written between rounds. Rows only ever meet by node.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(both.distinct(), "edges")
    labels = materialize(
        edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels"
    )
    if not labels.limit(1).count():
        return labels
    while True:
        seen = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        near = labels.join(seen, labels["node"] == seen["a"]).select("node", F.least("label", "m").alias("n"), F.col("label").alias("was"))
        near = materialize(near, "near")
        up = near.select(F.col("node").alias("t"), F.col("n").alias("top"))
        jumped = near.join(up, near["n"] == up["t"]).select("node", F.least("n", "top").alias("label"), "was")
        jumped = materialize(jumped, "labels")
        labels = jumped.select("node", "label")
        if not jumped.filter("label <> was").limit(1).count():
            return labels
