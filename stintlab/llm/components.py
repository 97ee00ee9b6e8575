"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.llm.common import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _towards_least(sides: DataFrame, keep) -> DataFrame:
    """For each node u of sides (u, v): its kept neighbours linked to the least of all and u.

    The least values are written before the join, so that both its sides are plain shuffles and
    Spark can split a node with very many links.
    """
    least = stage(sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")))
    joined = sides.join(least, "u")
    return joined.filter(keep).select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b")


def connected_components(links: DataFrame) -> DataFrame:
    """node, label from links (a, b): label is the least node reachable.

    Nodes without a link to another are not in the result. Every round is a written table; the
    number of rounds grows with the logarithm of the longest path.
    """
    edges = stage(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = _state(edges)
    while before[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = stage(_towards_least(both, F.col("v") > F.col("u")).distinct())
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = _towards_least(down, F.lit(True)).unionByName(
            down.groupBy("u").agg(F.min("v").alias("b")).select(F.col("u").alias("a"), "b")
        )
        edges = stage(small.distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
