"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.session import materialize


def components(links: DataFrame) -> DataFrame:
    """node, root of every linked node; the root is the smallest node that can be reached.

    `links` has columns a and b of one ordered type; loops, repeats and both directions are allowed.
    Large-star and small-star steps alternate until every node points at its root: each replaces
    neighbours by smaller ones, and the number of links never grows. Links stay distributed and are
    written after every round; only their number and a hash sum reach the driver. A node with very
    many links is combined before the shuffle where its minimum is taken, and the joins by node
    leave it to Spark to split such a node's rows.
    """
    edges = materialize(_tidy(links.select("a", "b")), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _tidy(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(_tidy(small.union(down.select("a", "m"))), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 31))).first()
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _tidy(links: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller node, without loops."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
