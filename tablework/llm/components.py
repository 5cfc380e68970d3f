"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm.tables import stage
from tablework.operators.joins import lookup


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges(a, b)``; the label is the smallest node of the component.

    Each round points every node at the smallest node it knows of, until no
    edge changes; the number of rounds grows with the logarithm of the longest
    path. Rounds are written to the shared folder. Loops, repeated and
    reversed edges are allowed; null ends are ignored.
    """
    edges = stage(_ordered(edges.select("a", "b")), "edges")
    before = None
    while (now := _signature(edges)) != before:
        edges, before = stage(_small_star(_large_star(edges)), "edges"), now
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return _ordered(lookup(both.where("b > a"), least, ["a"]).select(F.col("b").alias("a"), F.col("least").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = lookup(edges, least, ["a"]).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _ordered(moved.unionByName(least.select("a", F.col("least").alias("b"))))


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
