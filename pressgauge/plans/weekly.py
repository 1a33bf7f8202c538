"""The periodic report: every table of one date range and topic."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from pressgauge.operators import report
from pressgauge.operators.dedupe import consolidate_entities, consolidate_news
from pressgauge.session import cut_lineage
from pressgauge.sources.store import ArticleStore


def report_tables(
    news: DataFrame, ner: DataFrame, national: str = report.NATIONAL, top: int = 30, **table_options
) -> dict[str, DataFrame]:
    """Report tables from consolidated articles and entities."""
    articles = report.article_table(news, **table_options)
    entities = report.entity_table(ner)
    edges = report.network_edges(ner, top)
    stats = report.province_stats(news, ner, national)
    return {
        "province_stats": stats,
        "province_chart": report.chart_input(stats),
        "articles": articles.drop("autores", "portal", "link"),
        "entities_personas": entities.select("`Ref.art`", "personas"),
        "entities_lugares": entities.select("`Ref.art`", "lugares"),
        "entities_organizaciones": entities.select("`Ref.art`", "organizaciones"),
        "network": report.person_network(ner),
        "edges": edges,
        "nodes": report.network_nodes(edges),
    }


def weekly_report(
    store: ArticleStore,
    start: date | str,
    end: date | str,
    topic: str | None = None,
    **options,
) -> dict[str, DataFrame]:
    """Read, consolidate once, then build every table from the written intermediates."""
    news = cut_lineage(consolidate_news(store.get_news(start, end, topic)), "report-news")
    ner = cut_lineage(consolidate_entities(store.get_entities(news)), "report-ner")
    return report_tables(news, ner, **options)


def write_report(tables: dict[str, DataFrame], folder: str) -> None:
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}")
