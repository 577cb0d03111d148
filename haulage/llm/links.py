"""Connected components of links between numbered nodes, by alternating large and small stars.

A large star ties the larger neighbours of every node to its smallest neighbour, a small star the smaller
ones; both keep components and in a few rounds leave stars round the smallest nodes. Minima are aggregated
before they are shuffled and joined back, so a node with many links is no group of one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch


def _large_star(links: DataFrame, tables: Scratch) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = tables.write(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame, tables: Scratch) -> DataFrame:
    least = tables.write(links.groupBy("u").agg(F.min("v").alias("m")))
    tied = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, tables: Scratch) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every linked node but the smallest ones.

    ``links`` has columns u and v. Rounds go on until nothing changes: links are compared by number and
    by the sum of their hashes.
    """
    u, v = F.greatest("u", "v"), F.least("u", "v")
    links = tables.write(links.where("u <> v").select(u.alias("u"), v.alias("v")).distinct())
    mark = None
    while True:
        now = links.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
        mark = now
        links = tables.write(_small_star(_large_star(links, tables), tables))
