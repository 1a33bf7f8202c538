"""Data-quality profiles and small aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls), every column in one pass."""
    counted = df.agg(
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
    )
    return counted.unpivot([], df.columns, "column", "nulls")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def repeated_links(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most repeated (link, date_article) pairs with their mean text length."""
    return (
        df.groupBy("link", "date_article")
        .agg(
            F.count(F.lit(1)).alias("count_ocurrence"),
            F.avg(F.char_length("content")).alias("avg_content_length"),
        )
        .orderBy(F.desc("count_ocurrence"), "link", "date_article")
        .limit(n)
    )


def count_true(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(f)).alias(f) for f in flags])
