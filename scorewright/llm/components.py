"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _smallest(pairs: DataFrame) -> DataFrame:
    """For each ``u`` the least of itself and its partners.  Minimum combines map-side; the join back splits a hub."""
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return (both.join(_smallest(both), "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = _smallest(down)
    moved = (down.join(least, "u").filter(F.col("v") != F.col("m"))
             .select(F.col("v").alias("a"), F.col("m").alias("b")))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(own).filter("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of longs -> (node, component): the least node reachable, one row per node that has a link.

    Every round is a few shuffles of the remaining links and is written to the shared folder; a round turns paths
    into stars, so the number of rounds grows with the logarithm of the longest path.  Self-links, repeated links
    and null ends are allowed and add nothing; an empty table gives an empty table."""
    edges = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    mark = None
    while True:
        nxt = stored(_small_star(_large_star(edges)), "links")
        now = nxt.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(edges)
        edges = nxt
        if tuple(now) == mark:
            break
        mark = tuple(now)
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
