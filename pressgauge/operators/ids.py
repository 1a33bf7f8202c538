"""Consecutive article ids without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressgauge.session import cut_lineage

# monotonically_increasing_id keeps the partition above bit 33, the row below.
ROW_BITS = 33


def max_index(df: DataFrame, id_col: str = "index") -> DataFrame:
    """One row with the largest id; null on an empty table."""
    return df.agg(F.max(id_col).alias("max_index"))


def next_index(store: DataFrame, id_col: str = "index") -> int:
    """First free id; an empty store starts at 1."""
    return (max_index(store, id_col).first()["max_index"] or 0) + 1


def assign_ids(df: DataFrame, order_by: list[str], start: int = 1, id_col: str = "index") -> DataFrame:
    """Ids ``start``, ``start + 1``, … in the order of the (unique) sort columns.

    Rows are range-partitioned and sorted, their place in the partition is fixed by
    writing them out, and each partition gets the number of rows before it. The offset
    table has one row per partition, so broadcasting it is bounded by their number.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id()),
        "ids",
    )
    part = F.shiftright("_place", ROW_BITS).alias("_part")
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    row = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(id_col, F.lit(start).cast("bigint") + F.col("_off") + row)
        .drop("_place", "_part", "_off")
    )
