"""Connected components of a graph, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node it is connected with) of every node of a link.

    Each round gives a node the smallest label among itself and its neighbours and then its label's label, so the rounds
    grow with the logarithm of a chain's length. Every round is written to the shared folder. Null ends are ignored.
    """
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null and x != y")
    edges = materialize(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "component-edges")
    labels = materialize(edges.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("node"), F.least("x", "y").alias("component")), "component-labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "y"), "y").groupBy(F.col("x").alias("node")).agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        step = materialize(step, "component-labels")
        jump = step.select(F.col("node").alias("component"), F.col("component").alias("further"))
        step = step.join(jump, "component").select("node", "was", F.least("component", "further").alias("component"))
        step = materialize(step, "component-labels")
        changed = not step.where("was != component").isEmpty()
        labels = step.select("node", "component")
        if not changed:
            return labels
