"""Extraction funnel: how many links survive each relevance step, per portal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def extraction_funnel(portals: DataFrame, flagged: DataFrame, url: str = "url") -> DataFrame:
    """One row per portal from links flagged ``match1`` and ``match2``.

    Portals without any link stay in, with zero counts and ``fail_build`` true.
    """
    counts = flagged.groupBy(url).agg(
        F.count(F.lit(1)).alias("total_articles"),
        F.count_if("match1").alias("match1_url"),
        F.count_if("match2").alias("match2_url_topic_related"),
    )
    joined = portals.select(url).distinct().join(counts, url, "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        url,
        F.col("total_articles").isNull().alias("fail_build"),
        *[
            F.coalesce(c, zero).alias(c)
            for c in ("total_articles", "match1_url", "match2_url_topic_related")
        ],
    ).withColumn(
        "related_ratio",
        F.round(
            F.coalesce(
                F.try_divide(F.col("match2_url_topic_related"), F.col("total_articles")), F.lit(0.0)
            ),
            4,
        ),
    )


def text_volume(df: DataFrame, group: str, text: str, related: str) -> DataFrame:
    """Articles and characters per group, in all and where the ``related`` flag holds."""
    size = F.char_length(text).cast("bigint")
    zero = F.lit(0).cast("bigint")
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("total_articles"),
        F.count_if(related).alias("related_articles"),
        F.sum(size).alias("total_text_analysed"),
        F.sum(F.when(F.col(related), size).otherwise(zero)).alias("total_text_related"),
    )
