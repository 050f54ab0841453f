"""Connected components of an edge table, by contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillroll.llm.common import cut


def _both(e: DataFrame) -> DataFrame:
    return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); one root per component.

    In each round every root moves to its smallest neighbour, two steps at
    once, and the edges are contracted.  Tables are written between rounds, so
    joins on a node with very many edges start from fresh shuffles that Spark
    can split.  NULL ends and loops are ignored.
    """
    e = edges.where(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    e = cut(e, "edges")
    labels = cut(_both(e).select(F.col("a").alias("node")).distinct()
                 .withColumn("root", F.col("node")), "labels")
    while not e.isEmpty():
        up = cut(_both(e).groupBy("a").agg(F.min("b").alias("to")).where("to < a"), "hooks")
        again = up.select(F.col("a").alias("to"), F.col("to").alias("further"))
        up = cut(up.join(again, "to", "left").select("a", F.coalesce("further", "to").alias("to")), "hooks")
        labels = cut(labels.join(up.select(F.col("a").alias("root"), "to"), "root", "left")
                     .select("node", F.coalesce("to", "root").alias("root")), "labels")
        for end in ("a", "b"):
            e = e.join(up.select(F.col("a").alias(end), F.col("to").alias("moved")), end, "left")
            e = e.withColumn(end, F.coalesce("moved", end)).drop("moved")
        e = cut(e.where(F.col("a") != F.col("b")).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    return labels
