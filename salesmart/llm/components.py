"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.storage import written


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``component``) for each end of a link (``a``, ``b``); a component is named by its smallest node.

    Each round merges every node into its smallest neighbour and keeps the links between what is left. A round at
    least halves the nodes of each component, so their number grows with the logarithm of the largest one. Neighbours
    are reduced to a minimum before they are shuffled; each round's tables are written, none is collected.
    """
    edges = written(links.select("a", "b").where("a <> b").distinct(), "links")
    labels = None
    while not edges.isEmpty():
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = written(ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("from"), F.least("a", "b").alias("to")), "parents")
        if labels is None:
            labels = parents.select(F.col("from").alias("node"), F.col("to").alias("component"))
        else:
            labels = labels.join(parents, F.col("component") == F.col("from"), "left").select("node", F.coalesce("to", "component").alias("component"))
            labels = written(labels, "labels")
        first = edges.join(parents, F.col("a") == F.col("from")).select(F.col("to").alias("x"), "b")
        both = first.join(parents, F.col("b") == F.col("from")).select("x", F.col("to").alias("y"))
        edges = written(both.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
