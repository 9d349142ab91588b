"""Connected components of a link table, by least labels passed along links with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .worker import discard, release

#: Steps between two written tables.
STEPS = 3


def _both_ways(links: DataFrame) -> DataFrame:
    one = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b")
    return one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def _step(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Every node takes the least label of itself and its neighbours, then the label that this one had.

    Neighbours' labels meet as partial minima, so a node with very many links
    is not gathered in one task.
    """
    near = edges.join(labels.select(F.col("node").alias("b"), "class"), "b").groupBy(F.col("a").alias("node")).agg(F.min("class").alias("m"))
    taken = labels.join(near, "node", "left").select("node", F.least("class", "m").alias("took"))
    return taken.join(labels.select(F.col("node").alias("took"), F.col("class").alias("at")), "took").select("node", F.least("took", "at").alias("class"))


def partial_labels(links: DataFrame) -> DataFrame:
    """node, class after a few steps: equal classes are connected, connected nodes mostly have equal classes."""
    edges = cut_lineage(_both_ways(links))
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("class"))
    for _ in range(STEPS - 1):
        labels = _step(edges, labels)
    labels = cut_lineage(labels)
    discard(edges)
    return labels


def components(links: DataFrame) -> DataFrame:
    """node, class: the least node of its component, for every node of ``links`` (columns a and b, long).

    Pointer jumping halves distances, so the steps grow with the logarithm of
    the longest chain.
    """
    spark = links.sparkSession
    edges = cut_lineage(_both_ways(links))
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("class"))
    while True:
        start, new = labels, labels
        for _ in range(STEPS):
            new = _step(edges, new)
        new = cut_lineage(new.join(start.select("node", F.col("class").alias("was")), "node")
                          .select("node", "class", (F.col("class") != F.col("was")).alias("changed")))
        labels = new.select("node", "class")
        if not new.filter("changed").limit(1).count():
            break
    discard(edges)
    release(spark)
    return labels
