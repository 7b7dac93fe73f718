"""Connected components of a link table, as joins that repeat until no label changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitframe.sources.tables import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) to (id, component): the smallest id that each can reach. Ids without a link have no row.

    Every round takes the smallest label among the neighbours and then the label of that label, so the number of rounds
    grows with the logarithm of the longest chain. Only a count reaches the driver; each round is a written table.
    """
    both = materialise(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = materialise(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(near, F.col("id") == F.col("a")).select("id", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        of = labels.select(F.col("id").alias("label"), F.col("component").alias("label_of"))
        jumped = lower.join(of, F.col("component") == F.col("label")).select("id", "before", F.least("component", "label_of").alias("component"))
        after = materialise(jumped, "labels")
        if after.where("component <> before").isEmpty():
            return after.select("id", "component")
        labels = after.select("id", "component")
