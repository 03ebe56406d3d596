"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """vertex and component (its smallest vertex), for the vertices of ``edges`` (a, b).

    Each round gives a vertex the smallest label around it, then that label's own label,
    so paths shrink by about half a round. All state is in written tables.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.where("a <> b").distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("a").alias("b"), "label"), "b").groupBy("a")
        lowest = labels.join(near.agg(F.min("label").alias("low")), "a").select(
            "a", "label", F.least("label", "low").alias("low")
        )
        jump = labels.select(F.col("a").alias("low"), F.col("label").alias("jumped"))
        # A label is a vertex with a label of its own, never a larger one.
        after = lowest.join(jump, "low").select(
            "a", F.least("low", "jumped").alias("label"), F.col("label").alias("before")
        )
        after = written(after, "labels")
        changed = after.where("label <> before").limit(1).count()
        labels = after.select("a", "label")
        if not changed:
            return labels.select(F.col("a").alias("vertex"), F.col("label").alias("component"))
