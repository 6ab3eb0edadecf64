"""Connected components of a table of links, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import stored


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every end of ``links(a, b)``; the least node names it.

    Each round every node takes the least label among its neighbours and then
    the label of its label, so that a chain of n links settles in about log n
    rounds.  A hub with many links is met by partial aggregation and by AQE's
    splitting of skewed joins.  Labels are written each round.
    """
    edges = stored(
        links.select("a", "b").where("a <> b").union(links.select("b", "a").where("a <> b"))
        .toDF("a", "b").distinct()
    )
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("component")))
    for _ in range(most_rounds):
        near = edges.join(labels, edges.b == labels.node).groupBy("a").agg(
            F.min("component").alias("least"))
        met = labels.join(near, labels.node == near.a, "left").select(
            "node", "component", F.least("component", "least").alias("target"))
        jump = labels.select(F.col("node").alias("at"), F.col("component").alias("further"))
        new = stored(met.join(jump, met.target == jump["at"], "left").select(
            "node", F.coalesce(F.least("target", "further"), "target").alias("component"),
            (F.coalesce(F.least("target", "further"), "target") < F.col("component"))
            .alias("moved"),
        ))
        labels = new.select("node", "component")
        if new.where("moved").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
