"""Connected components of a table of links, without a task that sees a whole component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.session import materialize


def forest(links: DataFrame) -> DataFrame:
    """(node, parent) with one smaller parent per node, of links (a, b) of numbers.

    Every round ties each node to its smallest neighbour and hands its other smaller neighbours
    on to that one. Groups hold smaller neighbours only, so a number that a third of all others
    are linked to makes no large group unless it is the larger end.
    """
    ordered = links.where("a <> b").select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("below")
    )
    ordered = materialize(ordered.distinct(), "links")
    while True:
        least = ordered.groupBy("node").agg(F.min("below").alias("parent"), F.count("*").alias("n"))
        least = materialize(least, "parents")
        crowded = least.where("n > 1")
        if crowded.isEmpty():
            return least.select("node", "parent")
        others = ordered.join(crowded, "node").where("below > parent")
        moved = others.select(F.col("below").alias("node"), F.col("parent").alias("below"))
        tied = least.select("node", F.col("parent").alias("below"))
        ordered = materialize(tied.unionByName(moved).distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest number that can be reached, for every linked node."""
    tree = forest(links)
    while True:
        up = tree.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        raised = materialize(
            tree.join(up, "parent", "left").select(
                "node",
                F.coalesce("above", "parent").alias("parent"),
                F.col("above").isNotNull().alias("moved"),
            ),
            "tree",
        )
        done = raised.where("moved").isEmpty()
        tree = raised.select("node", "parent")
        if done:
            break
    roots = tree.select(F.col("parent").alias("node"), F.col("parent")).distinct()
    return tree.unionByName(roots).select("node", F.col("parent").alias("component"))
