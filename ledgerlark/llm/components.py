"""Connected components of a link table, by alternating stars, on tables alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, label: str = "cc") -> DataFrame:
    """(id, component) of each id in links (a, b): the smallest id it is linked with over any number of links.

    Each round hangs every larger neighbour, then every smaller one, onto the smallest neighbour, until nothing
    moves; rounds grow with the logarithm of the size. Ids without links don't appear.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges, step, last = scratch.save(edges, f"{label}-0"), 0, None
    while True:
        # Large star: each neighbour above u is hung onto u's smallest neighbour (or u).
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # Small star: u and its smaller neighbours are hung onto the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        step += 1
        following = scratch.save(small, f"{label}-{step}")
        mark = following.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        scratch.drop(f"{label}-{step - 1}")
        edges = following
        if mark == last:
            break
        last = mark
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
