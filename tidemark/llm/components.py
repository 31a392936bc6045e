"""Connected components of a link table by alternating large and small stars.

Every step is an aggregate and an equi-join on the node: aggregates combine
before the shuffle and skewed joins can be split, so a node with very many links
never gathers in one task.  The links are written to the shared folder after
each round; a lost executor re-reads files instead of repeating the rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _min_neighbour(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (its component's smallest node) of every linked node but the roots.

    ``links`` has two columns of one orderable type, named ``u`` and ``v``;
    null ends and self-links are ignored, an empty table gives no rows.
    """
    now = (links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
           .distinct())
    now = stage(now, "links")
    seen = None
    while True:
        # Large star: all larger neighbours of a node go to its smallest neighbour (or itself).
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _min_neighbour(both).select("u", F.least("u", "m").alias("m"))
        now = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        # Small star: a node's smaller neighbours, and the node, go to the smallest of them.
        least = _min_neighbour(now)
        joined = now.join(least, "u")
        now = (joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = stage(now, "links")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
