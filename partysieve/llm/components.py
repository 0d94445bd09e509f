"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partysieve.sources.stages import StageArea


def components(links: DataFrame, stages: StageArea, name: str = "components", rows: int | None = None) -> DataFrame:
    """The least node that each linked node reaches: node, component.

    links: columns a and b (long), both not null. Every round gives each node the least label among
    its neighbours', then follows the label's own label, so that long chains shorten by more than
    half. Rounds are written to the stage area; the driver only sees the number of changes.
    `rows`, if known, is how many links there are at most. Nodes of high degree: labels reach them through aggregates that combine on the map side.
    """
    both = stages.cut(links.where("a <> b").select("a", "b").distinct(), f"{name}-links", rows=rows)
    n = 2 * stages.rows[f"{name}-links"]  # no more nodes than ends of links
    both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stages.cut(both.groupBy("a").agg(F.min("b").alias("m"))
                        .select(F.col("a").alias("node"), F.least("a", "m").alias("component")), f"{name}-0", rows=n)
    step = 0
    while stages.rows[f"{name}-{step}"]:
        heard = (both.join(labels.withColumnRenamed("node", "b"), "b")
                 .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard")))
        near = labels.join(heard, "node").select("node", F.least("component", "heard").alias("next"), F.col("component").alias("old"))
        # The label is a node itself; its label now is at least as small.
        root = labels.select(F.col("node").alias("next"), F.col("component").alias("root"))
        step += 1
        moved = stages.cut(near.join(root, "next", "left")
                           .select("node", F.least("next", "root").alias("component"), "old"), f"{name}-{step}", rows=n)
        labels = moved.select("node", "component")
        if moved.where("component <> old").isEmpty():
            break
    return labels.select("node", "component")
