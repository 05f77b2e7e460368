"""Connected components of a graph of any size, on tables of edges.

Every node takes the least label among itself and its neighbours, and then the
label of its label (pointer jumping), until nothing changes; the number of rounds
is about the logarithm of the longest path.  Each round is written to the shared
scratch folder, so lineage stays short, and joins read both sides from tables, so
adaptive execution can split the rows of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """node, label (the least node of its component) for each end of ``edges`` (a, b: long)."""
    once = edges.filter("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = once.unionByName(once.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    both = scratch.materialise(both, "edges")
    labels = scratch.materialise(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("label")), "labels")
    for _ in range(MAX_ROUNDS):
        near = both.join(labels, both["v"] == labels["node"]).select(F.col("u").alias("node"), "label")
        least = near.unionByName(labels).groupBy("node").agg(F.min("label").alias("label"))
        least = scratch.materialise(least, "labels")
        up = least.select(F.col("node").alias("of"), F.col("label").alias("above"))
        jumped = scratch.materialise(least.join(up, F.col("label") == F.col("of")).select("node", F.least("label", "above").alias("label")), "labels")
        # The labels only fall, so equal sums mean equal labels.
        total = F.sum(F.col("label").cast("decimal(38,0)")).alias("s")
        if jumped.agg(total).collect() == labels.agg(total).collect():
            return jumped
        labels = jumped
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
