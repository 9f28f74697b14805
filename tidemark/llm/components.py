"""Connected components of a graph that lies in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); a component is named by its smallest node.

    Smallest labels travel along the edges and labels are followed to their own label in the same round, so the
    rounds grow with the logarithm of a component's width.  Each round is written to the shared folder.  A hub
    with very many edges is folded by partial aggregation, and its joins are split by adaptive execution.
    """
    both = stored(
        edges.where("a != b").select("a", "b").union(edges.where("a != b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "component-edges",
    )
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")), "component-labels")
    for _ in range(ROUNDS):
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard"))
        nearer = labels.join(heard, "node").select("node", F.col("component").alias("before"), F.least("component", "heard").alias("step"))
        of_step = labels.select(F.col("node").alias("step"), F.col("component").alias("jump"))
        moved = stored(
            nearer.join(of_step, "step", "left").select("node", F.least("step", F.coalesce("jump", "step")).alias("component"), "before"),
            "component-labels",
        )
        labels = moved.select("node", "component")
        if moved.where("component != before").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
