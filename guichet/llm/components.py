"""Connected components of a graph of links, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guichet.llm.store import written


def _climbed(parents: DataFrame) -> DataFrame:
    above = parents.select(F.col("node").alias("_n"), F.col("up").alias("_up"))
    return parents.join(above, F.col("up") == F.col("_n"), "left").select("node", F.coalesce("_up", "up").alias("up"))


def _moved(rows: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    above = parents.select(F.col("node").alias("_n"), F.col("up").alias("_up"))
    return rows.join(above, F.col(column) == F.col("_n"), "left").withColumn(column, F.coalesce("_up", column)).drop("_n", "_up")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b long): the smallest node it reaches.

    In each round every node hooks onto its smallest neighbour, if that is smaller than
    itself, climbs twice, and the links between what remains make the next round. All nodes
    but local minima leave in a round; the smallest of a component never does. Rounds and their
    steps are written to the shared folder, so that a node with very many neighbours is split
    by the joins. Links from a node to itself and null ends are ignored.
    """
    least, greatest = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    links = written(links.filter("a != b").select(least, greatest).distinct())
    labels = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("component", F.col("node"))
    while not links.isEmpty():
        parents = written(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")))
        parents = written(_climbed(written(_climbed(parents))))
        labels = written(_moved(labels, "component", parents))
        moved = _moved(_moved(links, "a", parents), "b", parents)
        links = written(moved.filter("a != b").select(least, greatest).distinct())
    return labels
