"""Connected components of a list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept


def _settled(stars: DataFrame) -> bool:
    """Whether every node is tied to one other at most, and that one to none."""
    ends = stars.select(F.explode(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("up")),
                                          F.struct(F.col("v").alias("n"), F.lit(0).alias("up")))).alias("e"))
    each = ends.groupBy("e.n").agg(F.sum("e.up").alias("up"), F.min("e.up").alias("least"))
    return not each.filter("up > 1 OR (up = 1 AND least = 0)").limit(1).count()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node`, `component` (its least node) for every node of the links.

    Alternating star contraction: each node's larger neighbours are tied to its least
    neighbour, then its smaller ones, until only stars remain, which takes a number of
    rounds logarithmic in the longest path. Minima are combined before they move. In the
    first half a node can have very many larger neighbours: there the minima are written
    before they are joined, so that both sides of the join come straight from a shuffle and
    a hot node is split. In the second half a node has few smaller ones left.
    """
    x, y = F.col(a), F.col(b)
    stars = links.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
    stars = kept(stars.distinct())
    while not _settled(stars):
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = kept(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = kept(small.union(lower.select("u", F.col("m").alias("v"))).distinct())
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
