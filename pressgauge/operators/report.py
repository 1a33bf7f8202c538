"""Report tables: province statistics, articles, entities and the person network."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressgauge.functions.dates import article_day, iso_day
from pressgauge.functions.text import hyperlink, portal_of_link

# Column names of the report tables.
GROUP_COLUMNS = {"PER": "personas", "LOC": "lugares", "ORG": "organizaciones", "MISC": "varios"}
NATIONAL = "Argentina"
SUMMARY_STATES = ("Jujuy",)
PORTAL_LABELS = {"argentina": "Gendarmería"}
ARTICLES_PER_PART = 10_000


def state_counts(news: DataFrame, national: str = NATIONAL) -> DataFrame:
    """(state, cantidad_noticias) without the national sources; a null state drops out."""
    return (
        news.filter(F.col("state") != national)
        .groupBy("state")
        .agg(F.count("state").alias("cantidad_noticias"))
    )


def entity_counts_per_article(ner: DataFrame) -> DataFrame:
    """One row per article with a count per entity group; null where there is none."""
    return ner.groupBy("index").agg(
        *[
            F.sum(F.when(F.col("entity_group") == g, F.lit(1).cast("bigint"))).alias(name)
            for g, name in GROUP_COLUMNS.items()
        ]
    )


def state_entity_pivot(news: DataFrame, ner: DataFrame, national: str = NATIONAL) -> DataFrame:
    """(state, personas, lugares, organizaciones, varios).

    Entities shrink to one row per article before they meet the states. Group names are
    listed, so the pivot needs no scan to find them and absent ones stay as null.
    """
    located = news.filter(F.col("state") != national).select("index", "state")
    return (
        entity_counts_per_article(ner)
        .join(located, "index")
        .groupBy("state")
        .agg(*[F.sum(name).alias(name) for name in GROUP_COLUMNS.values()])
    )


def state_entity_counts(news: DataFrame, ner: DataFrame, national: str = NATIONAL) -> DataFrame:
    """(state, entity_group, count), the long form of the pivot."""
    wide = state_entity_pivot(news, ner, national)
    named = wide.withColumnsRenamed({v: k for k, v in GROUP_COLUMNS.items()})
    return named.unpivot(["state"], list(GROUP_COLUMNS), "entity_group", "count").filter(
        F.col("count").isNotNull()
    )


def province_stats(news: DataFrame, ner: DataFrame, national: str = NATIONAL) -> DataFrame:
    """Articles and entities per province, most articles first, ``Total`` last.

    Columns: pos, provincia, cantidad_noticias, personas, lugares, organizaciones,
    varios. A total over nothing but nulls is null.
    """
    measures = ["cantidad_noticias", *GROUP_COLUMNS.values()]
    per_state = state_counts(news, national).join(
        state_entity_pivot(news, ner, national), "state", "left"
    )
    with_total = per_state.rollup("state").agg(
        F.grouping("state").alias("_total"), *[F.sum(m).alias(m) for m in measures]
    )
    # One row per province: the only window without a partition key runs on this.
    order = Window.orderBy("_total", F.desc("cantidad_noticias"), "state")
    label = F.when(F.col("_total") == 1, F.lit("Total")).otherwise(F.col("state"))
    return with_total.select(
        F.row_number().over(order).alias("pos"), label.alias("provincia"), *measures
    )


def chart_input(stats: DataFrame) -> DataFrame:
    return stats.filter(F.col("provincia") != "Total")


def article_table(
    news: DataFrame,
    summary_states: Sequence[str] = SUMMARY_STATES,
    portal_labels: Mapping[str, str] = PORTAL_LABELS,
) -> DataFrame:
    """Article list by state and day.

    Some states show the first 300 characters of the page summary instead of the
    generated one. The portal comes from the link.
    """
    summary = F.when(
        F.col("state").isin(list(summary_states)), F.substring("summary", 1, 300)
    ).otherwise(F.col("summary_llm"))
    portal: Column = F.col("_portal")
    label = portal
    for name, shown in portal_labels.items():
        label = F.when(portal == name, F.lit(shown)).otherwise(label)
    day = article_day(F.col("date_article"), F.col("date_extract"))
    return (
        news.withColumn("_portal", portal_of_link(F.col("link")))
        .withColumn("_day", day)
        .orderBy("state", "_day", "index")
        .select(
            F.col("index").alias("Ref.art"),
            F.col("state").alias("Pcia_Estado"),
            iso_day(F.col("_day")).alias("fecha_art"),
            F.coalesce(label, F.lit("n-a")).alias("portal"),
            F.col("authors").alias("autores"),
            F.col("title").alias("titular"),
            summary.alias("resumen"),
            "link",
            hyperlink(F.col("link")).alias("hyperlink"),
        )
    )


def entity_table(ner: DataFrame) -> DataFrame:
    """Words per article and entity group, joined by ``; `` in alphabetical order.

    A group holds the words of one article, so the lists are as short as the article.
    """
    def words_of(group: str) -> Column:
        found = F.array_sort(F.collect_list(F.when(F.col("entity_group") == group, F.col("word"))))
        return F.when(F.size(found) > 0, F.array_join(found, "; "))

    return ner.groupBy(F.col("index").alias("Ref.art")).agg(
        *[words_of(g).alias(name) for g, name in GROUP_COLUMNS.items()]
    )


def persons(ner: DataFrame) -> DataFrame:
    """(word, index): persons with two or more words; all-digit words are no names."""
    word = F.col("word")
    return ner.filter(
        (F.col("entity_group") == "PER") & ~word.rlike(r"^\p{N}+$") & F.contains(word, F.lit(" "))
    ).select("word", "index")


def person_occurrences(ner: DataFrame) -> DataFrame:
    return persons(ner).groupBy("word").agg(F.count(F.lit(1)).alias("occurrences"))


def person_network(ner: DataFrame, articles_per_part: int = ARTICLES_PER_PART) -> DataFrame:
    """(word, part, articles, occurrences): the articles of each person, ascending.

    A name may occur in a large share of all articles. Its list is split by id range
    into parts of at most ``articles_per_part`` ids, so no list grows without bound;
    concatenating the parts in order gives the whole list. ``occurrences`` counts all
    parts.
    """
    part = F.floor(F.col("index") / F.lit(articles_per_part)).cast("bigint")
    lists = (
        persons(ner)
        .groupBy("word", part.alias("part"))
        .agg(F.array_sort(F.collect_list("index")).alias("articles"))
    )
    sizes = lists.groupBy("word").agg(F.sum(F.size("articles")).alias("occurrences"))
    return lists.join(sizes, "word").select("word", "part", "articles", "occurrences")


def top_persons(ner: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent persons, ties by name."""
    return person_occurrences(ner).orderBy(F.desc("occurrences"), "word").limit(n)


def network_edges(ner: DataFrame, n: int) -> DataFrame:
    """(word, article) for the ``n`` most frequent persons; ``n`` rows are broadcast."""
    top = top_persons(ner, n).select("word")
    return (
        persons(ner)
        .join(F.broadcast(top), "word", "left_semi")
        .select("word", F.col("index").cast("string").alias("article"))
        .distinct()
    )


def network_nodes(edges: DataFrame) -> DataFrame:
    """(node, type) of both sides of the edges; a label on both sides is one article node."""
    sides = F.array(
        F.struct(F.col("word").alias("node"), F.lit("word").alias("type")),
        F.struct(F.col("article").alias("node"), F.lit("article").alias("type")),
    )
    return (
        edges.select(F.explode(sides).alias("_n"))
        .select("_n.*")
        .groupBy("node")
        .agg(F.min("type").alias("type"))
    )
