"""Connected components of a graph given as links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakelake.llm.support import stored


def _smallest(links: DataFrame, own: str, other: str) -> DataFrame:
    """(node, least) with the smallest of each node and its neighbours."""
    least = links.groupBy(F.col(own).alias("node")).agg(F.min(other).alias("least"))
    return least.select("node", F.least("node", "least").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(_smallest(both, "a", "b"), "large-star")
    joined = both.where("b > a").join(least, F.col("a") == F.col("node"))
    return joined.select(F.col("least").alias("a"), "b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    least = stored(_smallest(links, "b", "a"), "small-star")
    joined = links.join(least, F.col("b") == F.col("node"))
    moved = joined.where("a > least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("least").alias("a"), F.col("node").alias("b"))).distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; the root is the smallest node of its component.

    Links are (a, b) of longs; direction, repeats and loops do not matter. Each round stores its
    links in the shared folder, so a lost executor costs no more than a round. Smallest neighbours
    combine before their shuffle; joins take stored inputs, so a node with many links is split.
    """
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = stored(ordered.where("a < b").distinct(), "links")

    def seen(rows: DataFrame) -> tuple:
        return tuple(rows.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    before = seen(links)
    while before[0]:
        links = stored(_small_star(stored(_large_star(links), "links")), "links")
        after = seen(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)
