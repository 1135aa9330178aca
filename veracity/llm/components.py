"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.session import materialize, scratch_tables

MAX_ROUNDS = 64


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the least node reachable.

    Each round hangs the larger neighbours of a node under its least neighbour,
    then the smaller ones under theirs.  Nodes keep one row per link, so a hub
    is a key of an aggregate (combined before the shuffle), never a collected
    group; the number of rounds grows with the logarithm of the longest path.
    Rounds end when the links no longer change.
    """
    with scratch_tables() as scratch:
        links, before = materialize(_clean(links), "links"), None
        for _ in range(MAX_ROUNDS):
            earlier, links = links, materialize(_small_star(_large_star(links)), "links")
            scratch.drop(earlier)
            now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            if now == before:
                scratch.keep(links)
                return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                    links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
            before = now
        raise RuntimeError("the links did not settle")


def _clean(links: DataFrame) -> DataFrame:
    """Distinct links from the larger node ``a`` to the smaller ``b``."""
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return _clean(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    return _clean(links.join(least, "a").select("b", "m").toDF("a", "b").unionByName(least.toDF("a", "b")))
