"""Joins that stay even when one key holds a large share of the rows.

Keys with more than one ``max_hot``-th of all rows are hot. There cannot be more than
``max_hot`` of them, whatever the data, so they can be broadcast, and their rows join
without a shuffle. No other key is large enough to burden the task it is shuffled to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_HOT_KEYS = 100_000


def _split_hot(
    counts: DataFrame, key: str, count: str, max_hot: int
) -> tuple[DataFrame, DataFrame, Column]:
    """Hot keys, other keys (both with the key as ``_key``), and the join condition."""
    share = counts.agg((F.sum(count) / F.lit(max_hot)).alias("share")).scalar()
    marked = counts.withColumnRenamed(key, "_key").withColumn("_share", share)
    hot = marked.filter(F.col(count) > F.col("_share")).drop("_share")
    cold = marked.filter(F.col(count) <= F.col("_share")).drop("_share")
    return hot, cold, F.col(key).eqNullSafe(F.col("_key"))


def counted_join(
    big: DataFrame, counts: DataFrame, key: str, count: str, max_hot: int = MAX_HOT_KEYS
) -> DataFrame:
    """Give every row of ``big`` the columns of its key in ``counts``; nulls are one key.

    ``counts`` holds each key of ``big`` once with its number of rows.
    """
    hot, cold, same = _split_hot(counts, key, count, max_hot)
    near = big.join(F.broadcast(hot), same, "inner")
    rest = big.join(F.broadcast(hot.select("_key")), same, "left_anti")
    return near.unionByName(rest.join(cold, same, "inner")).drop("_key")


def skewed_join(
    big: DataFrame, lookup: DataFrame, key: str, how: str = "left", max_hot: int = MAX_HOT_KEYS
) -> DataFrame:
    """Join with a lookup table when the keys of ``big`` may be skewed; the same rows as a plain join.

    ``how`` is inner, left, left_semi or left_anti. The rows of ``big`` per key are counted first,
    which combines before its shuffle and costs one pass over its keys. Rows of hot keys meet
    their lookup row, one at most per key, by a broadcast; a hot key that the lookup repeats
    goes with the others through the shuffle, where Spark splits large partitions.
    """
    counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    share = counts.agg((F.sum("_n") / F.lit(max_hot)).alias("share")).scalar()
    hot = counts.withColumn("_share", share).filter(F.col("_n") > F.col("_share")).select(
        F.col(key).alias("_key")
    )
    if how in ("left_semi", "left_anti"):
        lookup = lookup.select(key).distinct()
    repeated = lookup.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_times"))
    apart = hot.join(repeated.filter(F.col("_times") > 1), "_key", "left_anti")
    is_apart = F.col(key).eqNullSafe(F.col("_key"))
    near = big.join(F.broadcast(apart), is_apart, "left_semi")
    rest = big.join(F.broadcast(apart), is_apart, "left_anti")
    found = lookup.join(F.broadcast(apart), F.col(key) == F.col("_key"), "left_semi")
    far = rest.join(lookup, key, how)
    return near.join(F.broadcast(found), key, how).select(*far.columns).unionByName(far)
