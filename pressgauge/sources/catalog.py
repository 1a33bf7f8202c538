"""Portal and keyword catalogues, and word vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressgauge import schemas
from pressgauge.operators.skew import skewed_join


def load_keywords(spark: SparkSession, path: str, topic: str = "narcotráfico") -> DataFrame:
    """(keywords) of one topic."""
    rows = spark.read.schema(schemas.TOPICS).option("header", True).csv(path)
    return rows.filter(F.col("topic") == topic).select("keywords")


def keyword_list(keywords: DataFrame, limit: int = 10_000) -> list[str]:
    """Keywords on the driver, as the relevance operators take them; size checked."""
    found = [r[0] for r in keywords.limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"more than {limit} keywords")
    return found


def load_portals(
    spark: SparkSession, path: str, topic: str | None = None, state: str | None = None
) -> DataFrame:
    """Portal catalogue, filtered by topic and state where given."""
    rows = spark.read.schema(schemas.PORTALS).option("header", True).csv(path)
    if topic is not None:
        rows = rows.filter(F.col("topic") == topic)
    if state is not None:
        rows = rows.filter(F.col("state") == state)
    return rows


def with_portal_place(articles: DataFrame, portals: DataFrame, url: str = "url") -> DataFrame:
    """State and city of the portal on each article; a portal may own many of them.

    A URL listed more than once takes its first place by name.
    """
    place = portals.groupBy(F.col("newsportalurl").alias(url)).agg(
        F.min(F.struct("state", "city")).alias("_p")
    )
    placed = skewed_join(articles, place, url, "left")
    return placed.select("*", "_p.state", "_p.city").drop("_p")


def load_word_vectors(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(rank, word, vec) of the vectors of one or more word2vec text files, all or the first ``limit``.

    Files follow one another by name, each with its header line, which has two fields. Spark promises no
    order over the splits of text files, so the rank is rebuilt: rows before the split, by file and
    byte offset, plus the row's place inside the split. There is one offset row per split, which
    bounds the broadcast.
    """
    lines = (
        spark.read.text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        )
        .withColumn("_vector", (F.size(F.split(F.rtrim("value"), " ")) > 2).cast("bigint"))
    )
    # Headers stand first in their file, so the vectors of a split are its last rows.
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        lines.groupBy("_file", "_block")
        .agg(F.sum("_vector").alias("_n"), F.max("_row").alias("_last"))
        .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    )
    rank = F.col("_off") + F.col("_n") - 1 - F.col("_last") + F.col("_row")
    fields = F.split(F.rtrim(F.col("value")), " ")
    placed = lines.join(F.broadcast(splits), ["_file", "_block"]).withColumn("rank", rank).filter("_vector = 1")
    if limit is not None:
        placed = placed.filter(F.col("rank") < limit)
    return placed.select(
        "rank",
        fields[0].alias("word"),
        F.slice(fields, F.lit(2), F.size(fields) - 1).cast("array<float>").alias("vec"),
    )
