"""Connected components of a table of links, by stars that shrink until they stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge.operators.skew import counted_join
from pressgauge.session import cut_lineage


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a grouped table that is narrow or small and read it back; at most four files a core, however many shuffle partitions."""
    return cut_lineage(df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism), label)


def _nearest(sides: DataFrame) -> DataFrame:
    """(u, v, m): each pair with the smallest value around ``u``, ``u`` included. Rows of a value with many links are not shuffled."""
    least = sides.groupBy("u").agg(F.min("v").alias("m"), F.count("v").alias("n"))
    known = settle(least.select("u", F.least("u", "m").alias("m"), "n"), "nearest")
    return counted_join(sides, known, "u", "n").drop("n")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _nearest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _nearest(down)
    return near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        near.select("u", F.col("m").alias("v"))
    )


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): every linked value with the smallest value it reaches.

    Values are longs. Links may repeat and point either way; self-links and links with a
    null are ignored, so an empty table gives an empty table. Each round is written out,
    and the rounds grow with the logarithm of the longest chain. Nothing is collected but
    two sums per round.
    """

    def settled(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    edges = settle(
        links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u != v").distinct(), "links"
    )
    mark = settled(edges)
    while mark[0]:
        large = settle(_large_star(edges), "large-star")
        edges = settle(_small_star(large).filter("u != v").distinct(), "links")
        before, mark = mark, settled(edges)
        if before == mark:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
