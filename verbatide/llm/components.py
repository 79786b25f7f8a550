"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is a grouped minimum and a join; links stay links to a node's smallest neighbour, so the
table never grows, and the number of rounds follows the logarithm of a component's size. Every
round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.llm.common import Scratch


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    higher = both.where(F.col("b") > F.col("a"))
    return higher.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    # links point from the larger to the smaller node
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where(F.col("b") != F.col("m"))
    moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) of every node of ``links(a, b)``; the component is its smallest node."""
    ordered = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now, mark = scratch.store(ordered.distinct(), "links"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == mark or not state[0]:
            break
        mark, before = tuple(state), now
        now = scratch.store(_small_star(_large_star(before)), "links")
        scratch.drop(before)
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    found = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return found.unionByName(roots)
