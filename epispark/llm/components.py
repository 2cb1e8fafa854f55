"""Connected components of a link table, by alternating large-star and
small-star steps (each a grouped minimum and a shuffle; O(log n) rounds on
the graphs met here).  Links live in tables under the checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, root) for every node ``u`` that has a link to another node, where
    ``root`` is the smallest node reachable; roots themselves are left out.
    ``links`` has columns u and v of one ordered type; self-links are ignored."""
    e = saved(links.select("u", "v").where("u <> v").distinct(), "links")
    if e.isEmpty():
        return e.select("u", F.col("v").alias("root"))
    while True:
        e = saved(_small_star(_large_star(e)), "stars")
        roots = e.select(F.col("v").alias("u")).distinct()
        # done when every node has one link and no root is a leaf of another
        many = e.groupBy("u").count().where("count > 1").limit(1)
        chained = e.join(roots, "u", "left_semi").limit(1)
        if many.union(chained).isEmpty():
            return e.select("u", F.col("v").alias("root"))
