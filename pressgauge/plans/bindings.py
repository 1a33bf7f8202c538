"""The given tables in the roles of the news workload."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.functions.text import clean_whitespace, content_hash, host_of_link, join_authors, spaced_words
from pressgauge.operators.entities import rule_entities
from pressgauge.operators.ids import assign_ids
from pressgauge.operators.word_groups import count_words
from pressgauge.session import cut_lineage

# Fixed values of the binding.
KEYWORDS = ("mente", "thing", "nicht", "ément", "ertion", "ciónas", "erung", "étion")
STEM_KEYWORDS = ("thation", "ertion", "ciónas", "étion", "nicht", "mente para", "which")
URL_KEYWORDS = ("blog", "spam", "feed")
STOP_WORDS = ("the", "of", "and", "de", "la", "que", "et", "der", "die", "und", "está", "más")
NATIONAL = "en"
SUMMARY_STATES = ("de",)
PORTAL_LABELS = {"src0": "Gendarmería"}
DIM = 64
THRESHOLD = 0.45
RUN_STAMP = "2023-08-16 10:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as stored articles.

    The language plays the state, the source plays portal and topic; the day follows
    from the source, the title is the first line, and a long title has no known day.
    """
    title = F.substring_index("text", "\n", 1)
    day = F.date_add(F.lit("2023-08-01").cast("date"), 3 * F.substring("source", 4, 9).cast("int"))
    www = F.when(F.col("lang") == "de", "https://").otherwise("https://www.")
    return table(spark, sf_dir, "documents").select(
        (F.col("doc_id") + 1).alias("index"),
        F.col("source").alias("topic"),
        day.alias("date_extract"),
        F.when(F.length(title) <= 120, F.date_sub(day, 1)).alias("date_article"),
        F.col("text").alias("content"),
        F.col("source").alias("portal"),
        F.concat(www, F.col("source"), F.lit(".example/"), F.md5(title)).alias("link"),
        title.alias("title"),
        clean_whitespace(F.col("text")).alias("summary"),
        title.alias("summary_llm"),
        F.lit("n-a").alias("authors"),
        F.col("lang").alias("state"),
        F.when(F.col("lang") != "fr", F.concat("lang", F.lit("-"), "source")).alias("city"),
        content_hash(F.col("text")).alias("content_hash"),
        F.col("n_chars").alias("content_nchar"),
    )


def dated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a day and authors: secure ones are of the run day, those with a mark of the day before."""
    url = F.col("url")
    day = F.when(F.contains(url, F.lit("#")), "2023-08-15").when(url.startswith("https"), RUN_STAMP[:10])
    folders = F.array_remove(F.split(F.regexp_extract(url, "^[a-z]+://[^/]+/([^?#]*)", 1), "/"), "")
    return table(spark, sf_dir, "pages").withColumns({"date_article": day, "authors": join_authors(folders)})


def portals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(host, state, city): hosts of the pages, with a row for each first folder, and of the sources, which have no pages."""
    state = F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z]+)", 1)
    crawled = table(spark, sf_dir, "pages").select(
        host_of_link(F.col("url")).alias("host"), state.alias("state"), F.upper(state).alias("city")
    )
    others = table(spark, sf_dir, "documents").select(
        F.concat("source", F.lit(".example")).alias("host"), F.col("lang").alias("state"), F.lit(None).cast("string").alias("city")
    )
    return crawled.unionByName(others).distinct()


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_entities(
        news(spark, sf_dir), "content", ("index", "link", "content_hash")
    )


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rank, word): words of four letters or more, most frequent first."""
    counted = (
        count_words(table(spark, sf_dir, "documents").select(spaced_words(F.col("text"))))
        .filter(F.length("word") > 3)
        .select("word", (-F.col("n")).alias("_order"))
    )
    return assign_ids(counted, ["_order", "word"], start=0, id_col="rank").select("rank", "word")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rank, word, vec): the word of rank r carries embedding r, as in a vector file.

    A written table: the vocabulary is counted over all texts, and most queries read the vectors more than once.
    """
    numbered = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("rank"), F.col("embedding").alias("vec")
    )
    return cut_lineage(vocabulary(spark, sf_dir).join(numbered, "rank").select("rank", "word", "vec"), "vectors")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles that have a label: the part of the collection already curated."""
    ids = table(spark, sf_dir, "labels").select((F.col("doc_id") + 1).alias("index"))
    return news(spark, sf_dir).join(ids, "index", "left_semi")


def false_positives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles marked for deletion."""
    return (
        table(spark, sf_dir, "labels")
        .filter(F.col("toxic") == 1)
        .select((F.col("doc_id") + 1).alias("index"))
    )


