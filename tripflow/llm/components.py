"""Connected components of a set of links, by label propagation with jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.work import staged


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (columns a, b): the smallest id reachable.

    Each round takes the least label among a node and its neighbours, then the
    label of that label, and writes the labels once; it ends when no label
    changed. Groupings combine map-side, and the joins read written tables, so
    a node with very many links is split by adaptive execution.
    """
    both = staged(
        links.select("a", "b").union(links.select("b", "a")).toDF("a", "b").distinct(), "links"
    )
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component"))
    labels = staged(labels, "labels")
    while True:
        seen = both.join(labels.toDF("b", "near"), "b").groupBy(F.col("a").alias("id"))
        lowest = labels.join(seen.agg(F.min("near").alias("near")), "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        jumps = labels.toDF("component", "further")
        jumped = lowest.join(jumps, "component", "left").select(
            "id", "old", F.least("component", "further").alias("component")
        )
        written = staged(jumped, "labels")
        labels = written.select("id", "component")
        if written.where("component <> old").isEmpty():
            return labels
