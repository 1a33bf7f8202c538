"""Article store: news, entities, embeddings and deletions as Parquet tables.

Layout under one folder: ``news`` and ``newsner`` partitioned by batch (news also by
extraction day), ``embeddings`` and ``tombstones`` append-only. A batch is written by
overwriting its own partition, so repeating a batch changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressgauge import schemas

BATCH = T.StructField("batch_id", T.LongType(), True)


def topic_matches(topic: str | None) -> Column:
    """Case-insensitive regular expression on the topic; no topic accepts all."""
    return F.lit(True) if not topic else F.col("topic").rlike(f"(?i){topic}")


def news_between(
    news: DataFrame, start: date | str, end: date | str, topic: str | None = None
) -> DataFrame:
    """Articles extracted between two days, both included."""
    day = F.col("date_extract").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return news.filter(day & topic_matches(topic))


def news_by_index(news: DataFrame, low: int, high: int, topic: str | None = None) -> DataFrame:
    return news.filter(F.col("index").between(low, high) & topic_matches(topic))


def entities_of(ner: DataFrame, news: DataFrame) -> DataFrame:
    """Entity rows of the given articles."""
    return ner.join(news.select("index"), "index", "left_semi")


def restore_types(df: DataFrame) -> DataFrame:
    """Dates from ``yyyy-MM-dd`` strings, for tables that store them as text."""
    return df.withColumns(
        {
            "date_extract": F.to_date(F.col("date_extract"), "yyyy-MM-dd"),
            "date_article": F.to_date(F.col("date_article"), "yyyy-MM-dd"),
        }
    )


def without_deleted(news: DataFrame, deleted: DataFrame) -> DataFrame:
    return news.join(deleted.select("index"), "index", "left_anti")


@dataclass(frozen=True)
class ArticleStore:
    spark: SparkSession
    path: str

    def _table(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def write_batch(self, news: DataFrame, ner: DataFrame, batch_id: int) -> None:
        """Both tables of one batch; running it again replaces the same partition."""
        news.select(*schemas.NEWS.names).write.mode("overwrite").option("compression", "zstd").partitionBy(
            "date_extract"
        ).parquet(f"{self.path}/news/batch_id={batch_id}")
        ner.select(*schemas.NEWSNER.names).write.mode("overwrite").parquet(
            f"{self.path}/newsner/batch_id={batch_id}"
        )

    def _all_news(self) -> DataFrame:
        return self._table("news", T.StructType([*schemas.NEWS.fields, BATCH]))

    def live_news(self) -> DataFrame:
        """Stored articles without the deleted ones."""
        return without_deleted(self._all_news(), self._table("tombstones", schemas.TOMBSTONES))

    def known_hashes(self, before_batch: int | None = None) -> DataFrame:
        """Content hashes of live articles, of earlier batches only where asked."""
        news = self.live_news()
        if before_batch is not None:
            news = news.filter(F.col("batch_id") < before_batch)
        return news.select("content_hash")

    def known_among(self, hashes: DataFrame, before_batch: int | None = None) -> DataFrame:
        """Known content hashes, of the given ones at least; a store with an index reads no others."""
        return self.known_hashes(before_batch)

    def next_index(self, before_batch: int | None = None) -> int:
        """First free id; deleted ids are not given out again."""
        news = self._all_news()
        if before_batch is not None:
            news = news.filter(F.col("batch_id") < before_batch)
        return (news.agg(F.max("index")).first()[0] or 0) + 1

    def get_news(
        self,
        start: date | str,
        end: date | str,
        topic: str | None = None,
        embed: bool = False,
    ) -> DataFrame:
        """Articles of a date range; the day prunes partitions, vectors only on request."""
        return self._shape(news_between(self.live_news(), start, end, topic), embed)

    def get_news_by_index(
        self, low: int, high: int, topic: str | None = None, embed: bool = False
    ) -> DataFrame:
        return self._shape(news_by_index(self.live_news(), low, high, topic), embed)

    def _shape(self, news: DataFrame, embed: bool) -> DataFrame:
        news = news.select(*schemas.NEWS.names)
        return news.join(self.embeddings(), "index", "left") if embed else news

    def entities(self) -> DataFrame:
        return self._table("newsner", T.StructType([*schemas.NEWSNER.fields, BATCH])).select(
            *schemas.NEWSNER.names
        )

    def get_entities(self, news: DataFrame) -> DataFrame:
        return entities_of(self.entities(), news)

    def embeddings(self) -> DataFrame:
        return self._table("embeddings", schemas.EMBEDDINGS)

    def add_embeddings(self, rows: DataFrame) -> None:
        rows.select(*schemas.EMBEDDINGS.names).write.mode("append").parquet(
            f"{self.path}/embeddings"
        )

    def delete(self, doomed: DataFrame) -> None:
        """Mark articles as deleted: their ids are appended, no data file is touched."""
        doomed.select("index").write.mode("append").parquet(f"{self.path}/tombstones")

    def delete_range(self, low: int, high: int, topic: str | None = None) -> None:
        self.delete(news_by_index(self.live_news(), low, high, topic))

    def delete_one(self, index: int) -> None:
        self.delete(self.live_news().filter(F.col("index") == index))
