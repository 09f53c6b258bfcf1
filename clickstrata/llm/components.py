"""Connected components of a table of links, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of a link; the component is its smallest node.

    Each round takes the smallest label among the neighbours and then the label of the
    label, which halves the way along chains.  A round ends as a written table,
    so lineage stays short; the driver learns only whether a label has changed.
    """
    there = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = stored(there.union(there.select("other", "node")).filter("node != other").distinct(), "links")
    labels = both.groupBy("node").agg(F.least("node", F.min("other")).alias("component"))
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "component"), "other").groupBy("node").agg(F.min("component").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        of_label = lower.select(F.col("node").alias("component"), F.col("component").alias("next"))
        after = stored(lower.join(of_label, "component").select("node", "was", F.col("next").alias("component")), "labels")
        labels = after.select("node", "component")
        if after.filter("component != was").isEmpty():
            return labels
