"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_003).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """``node`` and the smallest node it is linked with, for every node of the
    links ``(a, b)`` but the smallest ones of each component.

    Each round's links are written to the shared folder. Both stars keep one
    link for each node, so the table never grows, and joins split hot nodes.
    """
    links = materialize(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(links)
    while state[0]:
        turned = materialize(_small_star(_large_star(links)), "links")
        now = _state(turned)
        if now == state:
            break
        links, state = turned, now
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
