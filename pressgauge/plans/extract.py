"""Stored pages to raw articles and the extraction funnel, as one plan."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge.functions.html import page_title, paragraph_text
from pressgauge.functions.text import (
    char_count,
    content_hash,
    host_of_link,
    text_or_default,
)
from pressgauge.operators.clean import long_enough, same_day, usable
from pressgauge.operators.dedupe import keep_first
from pressgauge.operators.funnel import extraction_funnel
from pressgauge.operators.relevance import DEFAULT_THRESHOLD, keyword_match, matching, topic_similarity
from pressgauge.operators.summarize import with_summary
from pressgauge.session import cut_lineage
from pressgauge.sources.catalog import with_portal_place


def page_candidates(
    pages: DataFrame,
    keywords: Sequence[str],
    vectors: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    stop_words: Sequence[str] = (),
    similarity_keywords: Sequence[str] | None = None,
    similarity_text: str = "url",
) -> DataFrame:
    """(page_id, url, host, match1, match2, link_sim_score) of every page.

    The cheap word match runs on all links, the vectors only on links that passed it,
    and no page body is read for either when both work on the URL.
    """
    columns = dict.fromkeys(("page_id", "url", similarity_text))
    scored = keyword_match(pages.select(*columns), "url", keywords, stop_words)
    flagged = scored.withColumn("match1", F.size("matches") > 0)
    similarity = topic_similarity(
        flagged.filter("match1"),
        "page_id",
        similarity_text,
        similarity_keywords or keywords,
        vectors,
        stop_words,
    ).withColumnRenamed("score", "link_sim_score")
    return (
        flagged.select("page_id", "url", "match1")
        .join(similarity, "page_id", "left")
        .select(
            "page_id",
            "url",
            host_of_link(F.col("url")).alias("host"),
            "match1",
            F.coalesce(F.col("link_sim_score") > threshold, F.lit(False)).alias("match2"),
            "link_sim_score",
        )
    )


def extract_articles(
    pages: DataFrame,
    portals: DataFrame,
    keywords: Sequence[str],
    vectors: DataFrame,
    topic: str,
    run_stamp: str,
    summarize: Callable[[DataFrame, str], DataFrame] = with_summary,
    stop_words: Sequence[str] = (),
    **options,
) -> tuple[DataFrame, DataFrame]:
    """(statistics per portal, raw articles of the run day).

    ``portals`` has host, state and city; ``pages`` has page_id, url and html, and may
    have date_article and authors. A missing publication date counts as the run day.
    ``summarize`` adds the column summary. Pages whose address has no keyword are dropped where they are read, so
    their HTML never travels.
    """
    candidates = cut_lineage(
        page_candidates(pages, keywords, vectors, stop_words=stop_words, **options), "links"
    )
    stats = (
        extraction_funnel(portals, candidates, "host")
        .withColumnRenamed("host", "url")
        .select(F.lit(run_stamp).alias("date_extract"), F.lit(topic).alias("topic"), "*")
    )
    chosen = with_portal_place(
        candidates.filter("match2").select("page_id", "host", "link_sim_score"),
        portals.withColumnRenamed("host", "newsportalurl"),
        "host",
    )
    optional = [
        F.col(name).cast("string").alias(name) if name in pages.columns else F.lit(None).cast("string").alias(name)
        for name in ("date_article", "authors")
    ]
    matched = matching(pages.select("page_id", "url", "html", *optional), "url", keywords, stop_words)
    texts = (
        matched.join(chosen, "page_id")
        .withColumn("content", paragraph_text(F.col("html")))
        .filter(usable("content", "url"))
        .select(
            "page_id",
            F.lit(run_stamp).alias("date_extract"),
            F.coalesce("date_article", F.lit(run_stamp)).alias("date_article"),
            F.lit(topic).alias("topic"),
            "content",
            F.col("url").alias("link"),
            "link_sim_score",
            text_or_default(page_title(F.col("html"))).alias("title"),
            F.coalesce("authors", F.lit("n-a")).alias("authors"),
            F.col("host").alias("portal"),
            "state",
            "city",
            content_hash(F.col("content")).alias("content_hash"),
            char_count(F.col("content")).alias("content_nchar"),
        )
    )
    today = cut_lineage(long_enough(same_day(texts, run_stamp[:10])), "today")
    return stats, summarize(keep_first(today, "content_hash", "page_id"), "content")
