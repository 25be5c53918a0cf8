"""Connected components of links between fingerprints, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockaudit.llm.common import stored


def _mark(links: DataFrame) -> tuple:
    """Two sums that tell whether the links are the same as before."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), two longs; the root is the least node of its component.

    Links point down. Each round first hangs a node's larger neighbours under its least neighbour (or itself), then its
    smaller ones, which halves long chains; both halves are stored. It ends when a round changes nothing: then every
    node hangs under its root.
    """
    down = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    links = stored(links.where("a != b").select(*down).distinct(), "links")
    before, now = None, _mark(links)
    while now != before and now[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = stored(large.where("a != b").distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b")
        links = stored(small.union(least).distinct(), "links")
        before, now = now, _mark(links)
    return links.toDF("node", "root")
