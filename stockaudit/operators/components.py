"""Connected components of a graph given by its links, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockaudit.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), two longs; the root is the least node of its component.

    Alternating large and small stars: every round hangs each node's larger neighbours, then its smaller ones, under its
    least neighbour, until the links stay the same. Each round is stored, and nothing but two sums reaches the driver.
    """
    links = cut_lineage(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = cut_lineage(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        links = cut_lineage(small.select("b", "m").where("b != m").toDF("a", "b").union(least.toDF("a", "b")).distinct())
    return links.toDF("node", "root")
