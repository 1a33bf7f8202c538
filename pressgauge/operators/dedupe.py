"""Duplicate handling. Decisions are taken on keys; wide rows move at most once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge.functions.text import clean_entity
from pressgauge.operators.skew import counted_join, skewed_join


def keep_first(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """One row per key: the smallest ``row_id``.

    The aggregation combines before its shuffle, so a key with many copies costs one
    row per task; the semi join runs on the unique id and cannot skew.
    """
    kept = df.groupBy(key).agg(F.min(row_id).alias(row_id)).select(row_id)
    return df.join(kept, row_id, "left_semi")


def consolidate_news(news: DataFrame, row_id: str = "index") -> DataFrame:
    """Unique on content hash, then unique on link, smallest id kept each time."""
    by_hash = (
        news.groupBy("content_hash")
        .agg(F.min(F.struct(row_id, "link")).alias("first"))
        .select(f"first.{row_id}", "first.link")
    )
    kept = by_hash.groupBy("link").agg(F.min(row_id).alias(row_id)).select(row_id)
    return news.join(kept, row_id, "left_semi")


def consolidate_entities(ner: DataFrame) -> DataFrame:
    """Punctuation cleaned, blanks dropped, one row per (article, word).

    The highest score wins, then the smallest start, the group name, the earliest chunk.
    """
    cleaned = ner.withColumn("word", clean_entity(F.col("word"))).filter(F.col("word") != "")
    others = [c for c in ner.columns if c not in ("index", "word")]
    place = [c for c in ("start", "entity_group", "chunk_id") if c in others]
    rank = F.struct(-F.col("score"), *place)
    best = cleaned.groupBy("index", "word").agg(F.min_by(F.struct(*others), rank).alias("_b"))
    return best.select("index", "word", "_b.*").select(*ner.columns)


def duplicate_flag(df: DataFrame, key: str) -> DataFrame:
    """Add ``copies`` (rows with the same key) and ``duplicated``."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    flagged = counted_join(df, counts, key, "copies")
    return flagged.withColumn("duplicated", F.col("copies") > 1)


def unduplicated(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """Rows whose key occurs once; of a duplicated group no copy is kept."""
    single = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(row_id).alias(row_id))
        .filter(F.col("_n") == 1)
        .select(row_id)
    )
    return df.join(single, row_id, "left_semi")


def remove_known(batch: DataFrame, store: DataFrame, key: str = "content_hash") -> DataFrame:
    """Rows of the batch whose key the store does not hold yet.

    The key sets of both sides shrink to one row per key before they meet; of the batch
    rows, those of very frequent keys are decided without a shuffle.
    """
    known = store.select(key).distinct()
    return skewed_join(batch, known, key, "left_anti").select(*batch.columns)
