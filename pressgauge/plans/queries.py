"""Registered queries: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressgauge import schemas
from pressgauge.functions import dates, html, text
from pressgauge.functions.stem import spanish_stem
from pressgauge.operators import (
    chunks,
    dedupe,
    embed,
    entities,
    funnel,
    ids,
    keyword_blocks,
    profile,
    relevance,
    report,
    summarize,
    topics,
)
from pressgauge.plans import bindings as b
from pressgauge.plans.extract import extract_articles, page_candidates
from pressgauge.plans.transform import Settings
from pressgauge.session import cut_lineage, scratch_dir, ship_package
from pressgauge.sources import landing, store, versioned
from pressgauge.streaming import ordered
from pressgauge.streaming.ingest import ingest

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = build
    return build


# --- cleaning and profiles -------------------------------------------------------------


@query
def clean_content(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        text.char_count(F.col("text")).alias("n_raw"),
        text.byte_count(F.col("text")).alias("n_bytes"),
        text.clean_whitespace(F.col("text")).alias("content"),
    ).withColumn("n_clean", text.char_count(F.col("content")))


@query
def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents")
    return docs.select("doc_id", text.content_hash(F.col("text")).alias("content_hash"))


@query
def length_filter(spark: SparkSession, sf: str) -> DataFrame:
    from pressgauge.operators.clean import long_enough

    return long_enough(b.news(spark, sf)).select("index", "content_nchar")


@query
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    stamped = b.table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp")
    )
    day = dates.stamp_to_date(F.col("stamp"))
    return stamped.select(
        "event_id",
        day.alias("day"),
        dates.prefix_to_date(F.col("stamp")).alias("prefix_day"),
        dates.iso_day(day).alias("iso_day"),
    )


@query
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    articles = b.news(spark, sf).select("index", "date_article", "title", "city", "state")
    marks = b.table(spark, sf, "labels").withColumn("index", F.col("doc_id") + 1).drop("doc_id")
    return profile.null_profile(articles.join(marks, "index", "left"))


@query
def link_parts(spark: SparkSession, sf: str) -> DataFrame:
    link = F.col("link")
    return b.news(spark, sf).select(
        "index",
        text.portal_of_link(link).alias("portal"),
        text.host_of_link(link).alias("host"),
        text.drop_www_prefix(link).alias("bare"),
        text.headline_words(link, "https://www.").alias("words"),
        text.hyperlink(link).alias("hyperlink"),
    )


@query
def text_slices(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents")
    return docs.select(
        "doc_id", F.posexplode(text.slices(F.col("text"), 100)).alias("pos", "piece")
    )


@query
def joined_text(spark: SparkSession, sf: str) -> DataFrame:
    return b.news(spark, sf).select(
        "index",
        text.concat_or_null(*[F.col(c) for c in ("state", "city", "title", "summary_llm")]).alias(
            "tit_summary"
        ),
        text.word_count(F.col("content")).alias("n_words"),
    )


@query
def phrase_filter(spark: SparkSession, sf: str) -> DataFrame:
    content = F.col("content")
    return (
        b.news(spark, sf)
        .filter(F.contains(content, F.lit("tion")) & ~F.contains(content, F.lit("License")))
        .select("index", "link")
    )


@query
def portal_counts(spark: SparkSession, sf: str) -> DataFrame:
    articles = b.news(spark, sf).withColumn("host", text.host_of_link(F.col("link")))
    return profile.value_counts(articles, "host")


# --- duplicates ------------------------------------------------------------------------


@query
def dedup_content(spark: SparkSession, sf: str) -> DataFrame:
    kept = dedupe.keep_first(b.news(spark, sf), "content_hash", "index")
    return kept.select("index", "content_hash", "link")


@query
def consolidate_news(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.consolidate_news(b.news(spark, sf)).select("index", "link", "content_hash")


@query
def duplicate_flag(spark: SparkSession, sf: str) -> DataFrame:
    articles = b.news(spark, sf).select("index", "content_hash")
    return dedupe.duplicate_flag(articles, "content_hash")


@query
def unduplicated(spark: SparkSession, sf: str) -> DataFrame:
    kept = dedupe.unduplicated(b.news(spark, sf), "content_hash", "index")
    return kept.select("index", "content_hash")


@query
def dedup_against_store(spark: SparkSession, sf: str) -> DataFrame:
    batch = b.news(spark, sf).select("index", "link", "content_hash")
    return dedupe.remove_known(batch, b.labelled(spark, sf))


@query
def dup_top10(spark: SparkSession, sf: str) -> DataFrame:
    top = profile.repeated_links(b.news(spark, sf))
    return top.withColumn("avg_content_length", F.round("avg_content_length", 4))


# --- relevance -------------------------------------------------------------------------


@query
def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    tokens = text.without_stop_words(text.words(F.col("text")), b.STOP_WORDS)
    docs = b.table(spark, sf, "documents")
    return profile.value_counts(docs.select(F.explode(tokens).alias("word")), "word")


@query
def match_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Folded tokens: accented stop words pass unless folding comes last."""
    docs = b.table(spark, sf, "documents")
    before = text.match_tokens(F.col("text"), b.STOP_WORDS)
    after = text.match_tokens(F.col("text"), b.STOP_WORDS, fold_before_stop=False)
    return docs.select(
        "doc_id",
        F.size(before).cast("bigint").alias("n_fold_first"),
        F.size(after).cast("bigint").alias("n_stop_first"),
    )


@query
def stem_vocab(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents")
    vocabulary = docs.select(F.explode(text.words(F.col("text"))).alias("word")).distinct()
    return vocabulary.select("word", spanish_stem(F.col("word")).alias("stem"))


@query
def keyword_match_score(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents").select("doc_id", "text")
    scored = relevance.keyword_match(docs, "text", b.STEM_KEYWORDS, b.STOP_WORDS)
    return scored.select(
        "doc_id",
        "n_tokens",
        "match_score",
        F.size("matches").cast("bigint").alias("n_matches"),
        F.array_join("matches", " ").alias("matches"),
    )


@query
def any_keyword(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents")
    return docs.filter(text.contains_any(F.col("text"), b.KEYWORDS)).select("doc_id")


@query
def text_volume(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents").withColumn(
        "related", text.contains_any(F.col("text"), b.KEYWORDS)
    )
    return funnel.text_volume(docs, "source", "text", "related")


@query
def word_vectors(spark: SparkSession, sf: str) -> DataFrame:
    from pressgauge.functions.vectors import as_double, norm

    return b.vectors(spark, sf).select(
        "rank", "word", F.round(norm(as_double(F.col("vec"))), 4).alias("norm")
    )


@query
def vocabulary_similarity(spark: SparkSession, sf: str) -> DataFrame:
    sims = relevance.word_similarity(b.vectors(spark, sf), b.KEYWORDS)
    return sims.select("word", F.posexplode("sims").alias("keyword", "sim")).select(
        "word", "keyword", F.round("sim", 4).alias("sim")
    )


def _scores(spark: SparkSession, sf: str, keywords=b.KEYWORDS) -> DataFrame:
    docs = b.table(spark, sf, "documents")
    return relevance.topic_similarity(
        docs, "doc_id", "text", keywords, b.vectors(spark, sf), b.STOP_WORDS
    )


@query
def topic_similarity(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(spark, sf)


@query
def topic_similarity_many(spark: SparkSession, sf: str) -> DataFrame:
    """Similarity to a list of up to 2,000 keywords, the most frequent words that have a vector."""
    ship_package(spark)
    vectors = b.vectors(spark, sf)
    keywords = vectors.filter(F.col("rank") < 2_000).select(F.col("word").alias("keyword"))
    docs = b.table(spark, sf, "documents").select("doc_id", "text")
    return keyword_blocks.similarity_to_many(docs, "doc_id", "text", keywords, vectors, b.STOP_WORDS)


@query
def single_keyword_similarity(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(spark, sf, b.KEYWORDS[2:3])


@query
def relevance_split(spark: SparkSession, sf: str) -> DataFrame:
    """Counts on both sides of the threshold and inside the doubtful band."""
    band = (
        F.when(F.col("score") > 0.5, "above 0.5")
        .when(F.col("score") > 0.44, "0.44 to 0.5")
        .otherwise("0.44 or less")
    )
    return (
        _scores(spark, sf)
        .groupBy((F.col("score") >= b.THRESHOLD).alias("positive"), band.alias("band"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def best_keyword(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents")
    return relevance.best_keyword(
        docs, "doc_id", "text", b.KEYWORDS, b.vectors(spark, sf), 0.3, stop_words=b.STOP_WORDS
    )


@query
def funnel_by_source(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents").select("doc_id", "source", "text")
    flagged = relevance.keyword_match(docs, "text", b.STEM_KEYWORDS, b.STOP_WORDS).select(
        "doc_id", F.col("source").alias("url"), (F.size("matches") > 0).alias("match1")
    )
    both = flagged.join(_scores(spark, sf), "doc_id").withColumn(
        "match2", F.col("match1") & (F.col("score") > b.THRESHOLD)
    )
    return funnel.extraction_funnel(docs.select(F.col("source").alias("url")), both)


# --- pages -----------------------------------------------------------------------------


@query
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    pages = b.table(spark, sf, "pages")
    return pages.select(
        "page_id", F.explode(html.article_links(F.col("url"), F.col("html"))).alias("link")
    )


@query
def page_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = b.table(spark, sf, "pages")
    return pages.select(
        "page_id",
        html.page_title(F.col("html")).alias("title"),
        html.paragraph_text(F.col("html")).alias("content"),
    )


@query
def url_match(spark: SparkSession, sf: str) -> DataFrame:
    scored = relevance.keyword_match(b.table(spark, sf, "pages"), "url", b.URL_KEYWORDS)
    return scored.select("page_id", "n_tokens", "match_score", F.array_join("matches", " ").alias("matches"))


@query
def url_probe(spark: SparkSession, sf: str) -> DataFrame:
    pages = b.table(spark, sf, "pages").select("page_id", "url")
    probed = relevance.match_probe(pages, "url", "utm_source|spam", b.URL_KEYWORDS)
    return probed.select("page_id", "url", "match_score", F.array_join("matches", " ").alias("matches"))


@query
def page_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """URL words first, then similarity of the page, counted per host."""
    pages = b.table(spark, sf, "pages")
    candidates = page_candidates(
        pages,
        b.URL_KEYWORDS,
        b.vectors(spark, sf),
        0.2,
        similarity_keywords=b.KEYWORDS,
        similarity_text="html",
    )
    hosts = pages.select(text.host_of_link(F.col("url")).alias("host"))
    return funnel.extraction_funnel(hosts, candidates, "host")


def _extract(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return extract_articles(
        b.dated_pages(spark, sf),
        b.portals(spark, sf),
        b.URL_KEYWORDS,
        b.vectors(spark, sf),
        "feeds",
        b.RUN_STAMP,
        threshold=0.2,
        similarity_keywords=b.KEYWORDS,
        similarity_text="html",
        summarize=partial(summarize.with_summary, stop_words=b.STOP_WORDS),
    )


@query
def extract_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _extract(spark, sf)[0]


@query
def extract_run(spark: SparkSession, sf: str) -> DataFrame:
    """Articles of the run day with place, title, authors, summary and hash."""
    return _extract(spark, sf)[1]


# --- chunks and entities ---------------------------------------------------------------


@query
def chunks_fixed(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents").withColumn("text", text.clean_whitespace(F.col("text")))
    return chunks.explode_chunks(docs, chunks.fixed_chunks(F.col("text")), "doc_id")


@query
def chunks_words(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents").withColumn("text", text.clean_whitespace(F.col("text")))
    return chunks.explode_chunks(docs, chunks.word_chunks(F.col("text")), "doc_id")


@query
def entities_rules(spark: SparkSession, sf: str) -> DataFrame:
    return b.entities(spark, sf).drop("link", "content_hash")


@query
def consolidate_entities(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.consolidate_entities(b.entities(spark, sf)).select(
        "index", "word", "entity_group", "score", "chunk_id", "start"
    )


@query
def entities_gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    """Every mention of a name that the rules found as a person."""
    known = (
        report.persons(dedupe.consolidate_entities(b.entities(spark, sf)))
        .select("word")
        .distinct()
        .select("word", F.lit("PER").alias("entity_group"), F.lit(1.0).alias("score"))
    )
    return entities.gazetteer_entities(b.news(spark, sf), "content", known)


# --- report ----------------------------------------------------------------------------


def _consolidated(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Articles without copies and their entities; the entities are found once and written, whatever a report reads of them."""
    articles = dedupe.consolidate_news(b.news(spark, sf))
    found = cut_lineage(b.entities(spark, sf), "entities")
    return articles, dedupe.consolidate_entities(store.entities_of(found, articles))


@query
def province_stats(spark: SparkSession, sf: str) -> DataFrame:
    return report.province_stats(*_consolidated(spark, sf), b.NATIONAL)


@query
def province_chart(spark: SparkSession, sf: str) -> DataFrame:
    stats = report.province_stats(*_consolidated(spark, sf), b.NATIONAL)
    return report.chart_input(stats).select("pos", "provincia", "cantidad_noticias")


@query
def state_entity_counts(spark: SparkSession, sf: str) -> DataFrame:
    return report.state_entity_counts(*_consolidated(spark, sf), b.NATIONAL)


@query
def article_table(spark: SparkSession, sf: str) -> DataFrame:
    return report.article_table(
        dedupe.consolidate_news(b.news(spark, sf)), b.SUMMARY_STATES, b.PORTAL_LABELS
    )


@query
def entity_table(spark: SparkSession, sf: str) -> DataFrame:
    return report.entity_table(_consolidated(spark, sf)[1])


@query
def person_network(spark: SparkSession, sf: str) -> DataFrame:
    network = report.person_network(_consolidated(spark, sf)[1])
    return network.withColumn("articles", F.array_join("articles", ","))


@query
def top_persons(spark: SparkSession, sf: str) -> DataFrame:
    return report.top_persons(_consolidated(spark, sf)[1], 30)


@query
def network_edges(spark: SparkSession, sf: str) -> DataFrame:
    return report.network_edges(_consolidated(spark, sf)[1], 30)


@query
def network_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return report.network_nodes(report.network_edges(_consolidated(spark, sf)[1], 30))


# --- store -----------------------------------------------------------------------------


@query
def store_range(spark: SparkSession, sf: str) -> DataFrame:
    found = store.news_between(b.news(spark, sf), "2023-08-16", "2023-09-01", "SRC1")
    return found.select("index", "topic", "date_extract", "date_article", "title", "content_nchar")


@query
def store_by_index(spark: SparkSession, sf: str) -> DataFrame:
    found = store.news_by_index(b.news(spark, sf), 100, 853)
    return found.select("index", "topic", "state", "link")


@query
def entities_for_articles(spark: SparkSession, sf: str) -> DataFrame:
    wanted = b.labelled(spark, sf)
    return store.entities_of(b.entities(spark, sf), wanted).select(
        "index", "entity_group", "word", "chunk_id", "start"
    )


@query
def max_index(spark: SparkSession, sf: str) -> DataFrame:
    return ids.max_index(b.news(spark, sf))


@query
def assign_ids(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents").select("doc_id", "n_chars")
    return ids.assign_ids(docs, ["n_chars", "doc_id"], start=1001)


@query
def delete_range(spark: SparkSession, sf: str) -> DataFrame:
    articles = b.news(spark, sf).select("index", "topic", "link")
    doomed = store.news_by_index(articles, 100, 853, "src1")
    return store.without_deleted(articles, doomed)


@query
def delete_listed(spark: SparkSession, sf: str) -> DataFrame:
    articles = b.news(spark, sf).select("index", "topic", "link")
    return store.without_deleted(articles, b.false_positives(spark, sf))


def _stored(articles: DataFrame) -> DataFrame:
    """Articles with all columns of the store."""
    missing = [f for f in schemas.NEWS if f.name not in articles.columns]
    return articles.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}).select(*schemas.NEWS.names)


def _two_batches(spark: SparkSession, sf: str) -> versioned.VersionedStore:
    """A versioned store with the curated part as batch 0 and all other articles as batch 1."""
    store_ = versioned.VersionedStore(spark, scratch_dir(spark, "store"))
    no_entities = spark.createDataFrame([], schemas.NEWSNER)
    curated = b.labelled(spark, sf)
    others = b.news(spark, sf).join(curated.select("index"), "index", "left_anti")
    for batch, articles in enumerate((curated, others)):
        store_.write_batch(_stored(articles), no_entities, batch)
    return store_


@query
def dedup_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The collection against a store with the curated part, through the store's index of content hashes."""
    store_ = versioned.VersionedStore(spark, scratch_dir(spark, "store"))
    store_.write_batch(_stored(b.labelled(spark, sf)), spark.createDataFrame([], schemas.NEWSNER), 0)
    batch = b.news(spark, sf).select("index", "link", "content_hash")
    return dedupe.remove_known(batch, store_.known_among(batch, before_batch=1))


@query
def store_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches and a list of deletions as one run."""
    store_ = _two_batches(spark, sf)
    store_.delete(b.false_positives(spark, sf))
    store_.compact()
    return store_.live_news().select("index", "batch_id", "link", "content_hash", "date_extract", "content_nchar")


@query
def store_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Articles of an id range and of a day range, read through the ranges per file."""
    store_ = _two_batches(spark, sf)
    ids_ = store_.get_news_by_index(100, 853).select("index", "link", F.lit("index").alias("by"))
    days = store_.get_news("2023-08-16", "2023-09-01", "SRC1").select("index", "link", F.lit("day").alias("by"))
    return ids_.unionByName(days)


# --- text mining -----------------------------------------------------------------------


@query
def extractive_summary(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents")
    return summarize.extractive_summary(docs, "doc_id", "text", stop_words=b.STOP_WORDS)


@query
def doc_embedding(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents")
    vecs = embed.mean_word_vector(
        docs, "doc_id", "text", b.vectors(spark, sf), b.DIM, b.STOP_WORDS
    )
    return vecs.select("doc_id", F.posexplode("embeddings").alias("dim", "value")).select(
        "doc_id", "dim", F.round(F.col("value").cast("double"), 3).alias("value")
    )


@query
def embedding_backfill(spark: SparkSession, sf: str) -> DataFrame:
    articles = b.news(spark, sf).withColumn(
        "tit_summary",
        text.concat_or_null(*[F.col(c) for c in ("state", "city", "title", "summary_llm")]),
    )
    embedded = b.table(spark, sf, "embeddings").select((F.col("vec_id") + 1).alias("index"))
    rows = embed.backfill(
        articles, embedded, b.vectors(spark, sf), b.DIM
    )
    return rows.select("index", F.posexplode("embeddings").alias("dim", "value")).select(
        "index", "dim", F.round(F.col("value").cast("double"), 3).alias("value")
    )


@query
def bag_of_words(spark: SparkSession, sf: str) -> DataFrame:
    counts = topics.term_counts(b.table(spark, sf, "documents"), "doc_id", "text", b.STOP_WORDS)
    return counts.groupBy("term").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))


@query
def tfidf_top_terms(spark: SparkSession, sf: str) -> DataFrame:
    weighted = topics.tfidf(b.table(spark, sf, "documents"), "doc_id", "text", b.STOP_WORDS)
    return topics.top_terms(weighted, "doc_id", 10).select(
        "doc_id", "rank", "term", "tf", "df", F.round("weight", 5).alias("weight")
    )


@query
def lda_topics(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents").select("doc_id", "text")
    counts, vocabulary = topics.bag_of_words(docs, "text", b.STOP_WORDS)
    model = topics.fit_lda(counts)
    return topics.topic_words(model, vocabulary, 10)


@query
def topic_facts(spark: SparkSession, sf: str) -> DataFrame:
    """What holds of the topics' words whatever the model: ten different words of the collection, heaviest first."""
    docs = b.table(spark, sf, "documents").select("doc_id", "text")
    counts = cut_lineage(topics.term_counts(docs, "doc_id", "text", b.STOP_WORDS), "counts")
    terms = topics.term_ids(counts)
    model = topics.fit_topics(topics.weighted_vectors(counts, terms, "doc_id"))
    found = topics.topic_terms(model, terms, 10)
    heavier = F.lag("weight").over(Window.partitionBy("topic").orderBy("position"))
    return (
        found.withColumn("falls", F.coalesce(F.col("weight") <= heavier, F.lit(True)))
        .join(counts.groupBy("term").agg(F.sum("tf").alias("tf")), "term")
        .groupBy("topic")
        .agg(
            F.count_distinct("term").alias("n_words"), F.bool_and("falls").alias("descending"),
            F.bool_and((F.col("weight") > 0) & (F.col("weight") < 1)).alias("shares"), F.bool_and(F.col("tf") > 0).alias("known"),
        )
    )


# --- streaming -------------------------------------------------------------------------


def _raw_news(articles: DataFrame) -> DataFrame:
    """Stored articles as a landing file has them."""
    own = {
        "date_extract": F.concat(F.date_format("date_extract", "yyyy-MM-dd"), F.lit(" 10:00:00")),
        "date_article": F.date_format("date_article", "yyyy-MM-dd"),
        "link_sim_score": F.lit(0.5),
    }
    return articles.withColumns(own).select(*schemas.RAW_NEWS.names)


@query
def landed_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Two landed files of quoted CSV with the same articles, read back by blocks."""
    ship_package(spark)
    base = scratch_dir(spark, "landing")
    # The binding's summary is a second copy of the text, which a landing does not need.
    articles = _raw_news(b.news(spark, sf).withColumn("summary", F.lit(None).cast("string")))
    for stamp in ("2023-10-01_0600", "2023-10-02_0600"):
        articles.write.options(header=True, quote='"', escape='"').csv(f"{base}/{landing.landing_name('news', stamp)}")
    good, _ = landing.read_articles_by_blocks(spark, landing.landing_glob(base, "news"))
    return good.select("link", "title", "content_hash", "state", "city", "date_article", "content_nchar", F.sha2("content", 256).alias("content_sha256"))


def _settings(spark: SparkSession, sf: str) -> Settings:
    return Settings(
        b.KEYWORDS,
        b.vectors(spark, sf),
        b.DIM,
        b.STOP_WORDS,
        summarize=partial(summarize.extractive_summary, stop_words=b.STOP_WORDS),
    )


@query
def ingest_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """Files that land in the wrong order: the whole collection, then the older curated part with a record
    that is no article, then a still older file without articles. Loaded by the times in their names.
    """
    base = scratch_dir(spark, "ordered")
    folder, topic = f"{base}/landing", "news"
    store_ = versioned.VersionedStore(spark, f"{base}/store")
    curated = f"{folder}/{landing.landing_name(topic, '2023-10-01_0600')}"
    files = (
        (_raw_news(b.news(spark, sf)), f"{folder}/{landing.landing_name(topic, '2023-10-02_0600')}"),
        (_raw_news(b.labelled(spark, sf)), curated),
        (spark.createDataFrame([], schemas.RAW_NEWS), f"{folder}/{landing.landing_name(topic, '2023-09-30_0600')}"),
    )
    for articles, path in files:
        articles.write.options(header=True, quote='"', escape='"').csv(path)
    spark.createDataFrame([("header\nno article",)], "line string").write.mode("append").text(curated)
    ordered.ingest_ordered(
        spark, folder, topic, store_, _settings(spark, sf), f"{base}/checkpoint", archive=f"{base}/archive", stop_on_error=True
    )
    counts = store_.entities().groupBy("index").agg(F.count(F.lit(1)).alias("n_entities"))
    rejected = spark.read.parquet(f"{store_.path}/unparsed").agg(F.count(F.lit(1)).alias("n_unparsed")).scalar()
    return (
        store_.live_news()
        .join(counts, "index", "left")
        .select(
            "index", "batch_id", "content_hash", "link", "date_extract", "content_nchar", "summary_sim_score",
            F.coalesce("n_entities", F.lit(0)).cast("bigint").alias("n_entities"), rejected.alias("n_unparsed"),
        )
    )


@query
def ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Two landings through the stream: the curated part, then the whole collection.

    The second landing brings every curated article again; those add nothing.
    """
    base = scratch_dir(spark, "ingest")
    folder, topic = f"{base}/landing", "news"
    store_ = store.ArticleStore(spark, f"{base}/store")
    settings = _settings(spark, sf)
    landings = ((b.labelled(spark, sf), "2023-10-01_0600"), (b.news(spark, sf), "2023-10-02_0600"))
    for articles, stamp in landings:
        path = f"{folder}/{landing.landing_name(topic, stamp)}"
        # Spark reads a quoted file whole, packed or not.
        _raw_news(articles).write.options(header=True, quote='"', escape='"', compression="gzip").csv(path)
        ingest(
            spark,
            folder,
            topic,
            store_,
            settings,
            f"{base}/checkpoint",
            files_per_batch=10_000,
            stop_on_error=True,
        )
    counts = store_.entities().groupBy("index").agg(F.count(F.lit(1)).alias("n_entities"))
    return (
        store_.live_news()
        .join(counts, "index", "left")
        .select(
            "index",
            "batch_id",
            "content_hash",
            "link",
            "date_extract",
            "content_nchar",
            "summary_llm",
            "summary_sim_score",
            F.coalesce("n_entities", F.lit(0)).cast("bigint").alias("n_entities"),
        )
    )
