import datetime as dt
import os
from dataclasses import replace
from functools import partial

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pressgauge import schemas
from pressgauge.operators.summarize import extractive_summary
from pressgauge.plans.extract import extract_articles
from pressgauge.plans.transform import Settings, transform_batch
from pressgauge.plans.weekly import weekly_report, write_report
from pressgauge.session import shared_dir
from pressgauge.sources import catalog, landing
from pressgauge.sources.store import ArticleStore, restore_types
from pressgauge.streaming.ingest import ingest, requeue_quarantine

WORDS = [(0, "droga", [1.0, 0.0]), (1, "carga", [0.8, 0.6]), (2, "plaza", [0.0, 1.0])]


@pytest.fixture()
def settings(spark):
    vectors = spark.createDataFrame(WORDS, "rank bigint, word string, vec array<float>")
    return Settings(("droga", "plaza"), vectors, 2)


def raw(spark, articles):
    """Articles from (content, link, state, date_extract)."""
    data = [
        (d, d[:10], "narco", c, link, 0.5, f"titulo {link}", c, "n-a", "portal", s, "ciudad", None, None)
        for c, link, s, d in articles
    ]
    return spark.createDataFrame(data, schemas.RAW_NEWS)


DAY1, DAY2 = "2023-08-16 10:00:00", "2023-08-20 10:00:00"
FIRST = [
    ("Juan Perez y la droga.\nOtra linea.", "u1", "Salta", DAY1),
    ("Sin nombres, solo carga.", "u2", "Salta", DAY1),
    ("Sin nombres, solo carga.", "u0", "Salta", DAY1),
]
SECOND = [
    ("Juan Perez y la droga.\nOtra linea.", "u1", "Salta", DAY2),
    ("Ana Paz vio a Juan Perez en la plaza.", "u3", "Jujuy", DAY2),
]


def table(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_two_batches_and_a_repeat(spark, settings, tmp_path):
    store = ArticleStore(spark, str(tmp_path / "s"))
    assert store.next_index() == 1 and store.live_news().count() == 0
    assert transform_batch(raw(spark, FIRST), store, settings, 0)[0] == 2
    assert transform_batch(raw(spark, SECOND), store, settings, 1)[0] == 1
    before = table(store.live_news(), "index", "link", "batch_id", "summary_sim_score")
    assert [r[0] for r in before] == [1, 2, 3]
    assert {r[1] for r in before} == {"u0", "u1", "u3"}
    assert transform_batch(raw(spark, SECOND), store, settings, 1)[0] == 1
    assert table(store.live_news(), "index", "link", "batch_id", "summary_sim_score") == before
    assert store.embeddings().count() == store.embeddings().select("index").distinct().count() == 3
    news = store.get_news("2023-08-16", "2023-08-20")
    assert news.filter("link = 'u1'").first()["content"] == "Juan Perez y la droga. Otra linea."
    people = store.get_entities(news).filter("entity_group = 'PER'")
    assert table(people.join(news.select("index", "link"), ["index", "link"]), "link", "word") == [
        ("u1", "Juan Perez"), ("u3", "Ana Paz"), ("u3", "Juan Perez")]
    assert transform_batch(raw(spark, SECOND + FIRST), store, settings, 2)[0] == 0


def test_reads_prune_and_filter(spark, settings, tmp_path):
    store = ArticleStore(spark, str(tmp_path / "s"))
    transform_batch(raw(spark, FIRST), store, settings, 0)
    transform_batch(raw(spark, SECOND), store, settings, 1)
    day = store.get_news("2023-08-16", "2023-08-16", "NARC")
    assert table(day, "link") == [("u0",), ("u1",)]
    assert "embeddings" not in day.columns
    assert store.get_news("2023-08-16", "2023-08-16", "otro").count() == 0
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_extract" in plan
    embedded = store.get_news_by_index(1, 2, embed=True)
    assert embedded.count() == 2 and embedded.filter("embeddings is not null").count() == 2


def test_deletes_are_tombstones(spark, settings, tmp_path):
    store = ArticleStore(spark, str(tmp_path / "s"))
    transform_batch(raw(spark, FIRST), store, settings, 0)
    store.delete_one(2)
    assert table(store.live_news(), "index") == [(1,)]
    store.delete_range(1, 1, "otro")
    assert store.live_news().count() == 1
    store.delete_range(1, 9, "NARCO")
    assert store.live_news().count() == 0
    assert store.next_index() == 3  # deleted ids are not used again
    # a deleted article may come back with a later batch, under a new id
    assert transform_batch(raw(spark, FIRST[:1]), store, settings, 1)[0] == 1
    assert table(store.live_news(), "index") == [(3,)]


def test_weekly_report(spark, settings, tmp_path):
    store = ArticleStore(spark, str(tmp_path / "s"))
    transform_batch(raw(spark, FIRST), store, settings, 0)
    transform_batch(raw(spark, SECOND), store, settings, 1)
    tables = weekly_report(store, "2023-08-01", "2023-08-31", "narco", top=1)
    write_report(tables, str(tmp_path / "report"))
    stats = spark.read.parquet(str(tmp_path / "report/province_stats"))
    assert table(stats, "pos", "provincia", "cantidad_noticias", "personas") == [
        (1, "Salta", 2, 1), (2, "Jujuy", 1, 2), (3, "Total", 3, 3)]
    assert table(tables["edges"], "word") == [("Juan Perez",)] * 2
    assert set(os.listdir(tmp_path / "report")) == set(tables)


def land(spark, folder, stamp, articles, topic="narco"):
    path = f"{folder}/{landing.landing_name(topic, stamp)}"
    raw(spark, articles).toPandas().to_csv(path, index=False)
    return path


def test_stream_ingest_archive_rejects_and_quarantine(spark, settings, tmp_path):
    folder, archive = str(tmp_path / "output"), str(tmp_path / "archive")
    os.makedirs(folder)
    store = ArticleStore(spark, str(tmp_path / "s"))
    run = dict(folder=folder, topic="narco", store=store, settings=settings,
               checkpoint=str(tmp_path / "c"), archive=archive)
    land(spark, folder, "2023-08-16_1000", FIRST)
    ingest(spark, **run)
    assert store.live_news().count() == 2
    land(spark, folder, "2023-08-20_1000", SECOND + [("texto", "u9", "Salta", "2023-13-40 10:00:00")])
    ingest(spark, **run)
    assert table(store.live_news(), "index") == [(1,), (2,), (3,)]
    rejects = spark.read.parquet(f"{store.path}/rejects")
    assert table(rejects, "link", "reason") == [("u9", "bad date_extract")]
    # the same articles under a new name add nothing
    land(spark, folder, "2023-08-21_1000", FIRST)
    ingest(spark, **run)
    assert store.live_news().count() == 3
    assert any(files for _, _, files in os.walk(archive))
    # a failing step keeps the batch aside and the stream goes on

    def broken(df, key, text):
        raise RuntimeError("no model")

    land(spark, folder, "2023-08-22_1000", [("Texto nuevo.", "u10", "Salta", DAY2)])
    ingest(spark, **{**run, "settings": Settings(settings.keywords, settings.vectors, 2, summarize=broken)})
    kept = spark.read.parquet(f"{store.path}/quarantine")
    assert table(kept, "link", "error") == [("u10", "no model")]
    assert store.live_news().count() == 3
    # landed again, the batch is loaded once the step works
    requeue_quarantine(spark, store, folder, "narco", "2023-08-23_1000")
    ingest(spark, **run)
    assert store.live_news().count() == 4

    # a failure of the cluster ends the run and the batch is repeated

    def lost(df, key, text):
        raise OSError("disk lost")

    land(spark, folder, "2023-08-24_1000", [("Otro texto.", "u11", "Salta", DAY2)])
    with pytest.raises(StreamingQueryException):
        ingest(spark, **{**run, "settings": Settings(settings.keywords, settings.vectors, 2, summarize=lost)})
    ingest(spark, **run)
    assert store.live_news().count() == 5


def test_landing_files(spark, tmp_path):
    folder = str(tmp_path / "output")
    os.makedirs(folder)
    for stamp in ("2023-08-12_1735", "2023-08-09_1951", "2023-08-09_0830"):
        land(spark, folder, stamp, FIRST)
    land(spark, folder, "2023-01-01_0000", SECOND, topic="otro")
    names = [os.path.basename(r["path"]) for r in landing.list_landing(spark, folder, "narco").collect()]
    assert names == [f"news_narco_related_{s}.csv" for s in ("2023-08-09_0830", "2023-08-09_1951", "2023-08-12_1735")]
    articles, oldest = landing.read_oldest(spark, folder, "narco")
    assert oldest.endswith("2023-08-09_0830.csv")
    assert articles.filter(F.contains("content", F.lit("\n"))).count() == 1
    assert landing.archive_file(spark, oldest, str(tmp_path / "archive"))
    assert not landing.archive_file(spark, oldest, str(tmp_path / "archive"))
    assert len(os.listdir(tmp_path / "archive")) == 1 and len(os.listdir(folder)) == 3


def test_save_run_round_trip(spark, tmp_path):
    news = raw(spark, FIRST)
    stats = spark.createDataFrame([], schemas.STAT_ETL)
    path, stat_path = landing.save_run(stats, news, str(tmp_path), "narco", "2023-08-16_1000")
    assert os.path.basename(stat_path) == "stat_narco_related_2023-08-16_1000.csv"
    back = landing.read_articles(spark, path)
    assert back.exceptAll(news).count() == 0 and back.count() == 3
    with pytest.raises(ValueError):
        landing.save_run(stats, news, str(tmp_path), "narco", "x", mode="database")
    landing.write_clean(news, str(tmp_path / "clean"))
    assert spark.read.parquet(str(tmp_path / "clean/parquet")).count() == 3


def test_catalogue_and_word_vectors(spark, tmp_path):
    (tmp_path / "topics.csv").write_text("keywords,topic\ndroga,narco\nfrío,clima\ncarga,narco\n")
    (tmp_path / "portals.csv").write_text(
        "state,city,newsportalname,newsportalurl,topic\n"
        "Salta,Salta,Uno,https://uno/,narco\nCABA,Buenos Aires,Dos,https://dos/,clima\n"
    )
    words = catalog.load_keywords(spark, str(tmp_path / "topics.csv"), "narco")
    assert sorted(catalog.keyword_list(words)) == ["carga", "droga"]
    with pytest.raises(ValueError):
        catalog.keyword_list(words, limit=1)
    load = lambda **kw: catalog.load_portals(spark, str(tmp_path / "portals.csv"), **kw)
    assert load().count() == 2
    assert load(state="CABA").first()["newsportalname"] == "Dos"
    assert load(topic="narco", state="CABA").count() == 0
    articles = spark.createDataFrame([("https://uno/",), ("https://x/",)], "url string")
    assert table(catalog.with_portal_place(articles, load()), "url", "state") == [
        ("https://uno/", "Salta"), ("https://x/", None)]


def test_word_vector_ranks_over_many_splits(spark, tmp_path):
    lines = ["5000 2"] + [f"w{i} {i}.0 0.5" for i in range(5000)]
    (tmp_path / "v.vec").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        vectors = catalog.load_word_vectors(spark, str(tmp_path / "v.vec"), limit=4000)
        assert spark.read.text(str(tmp_path / "v.vec")).rdd.getNumPartitions() > 4
        assert vectors.count() == 4000
        assert vectors.filter(F.concat(F.lit("w"), "rank") != F.col("word")).count() == 0
        assert vectors.filter("rank = 17").first()["vec"] == [17.0, 0.5]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_word_vectors_of_several_files(spark, tmp_path):
    (tmp_path / "a.vec").write_text("2 2\nx 1.0 2.0\ny 3.0 4.0\n")
    (tmp_path / "b.vec").write_text("2 2\nz 5.0 6.0\nu 7.0 8.0\n")
    got = catalog.load_word_vectors(spark, str(tmp_path)).orderBy("rank").collect()
    assert [(r["rank"], r["word"]) for r in got] == [(0, "x"), (1, "y"), (2, "z"), (3, "u")]


def test_restore_types(spark):
    df = spark.createDataFrame([("2023-08-16", None)], "date_extract string, date_article string")
    assert restore_types(df).first()["date_extract"] == dt.date(2023, 8, 16)


def test_extract(spark):
    vectors = spark.createDataFrame(WORDS, "rank bigint, word string, vec array<float>")
    body = "<title>T &amp; U</title><p>" + "la droga en la plaza " * 30 + "</p>"
    pages = spark.createDataFrame(
        [
            (1, "https://uno.ar/droga-en-la-plaza", body, None),
            (2, "https://uno.ar/mas-droga", body, "2023-08-16"),
            (3, "https://uno.ar/droga-ayer", body + "<p>x", "2023-08-15"),
            (4, "https://uno.ar/deportes", body, None),
            (5, "https://dos.ar/droga", "<p>corto</p>", None),
        ],
        "page_id bigint, url string, html string, date_article string",
    )
    portals = spark.createDataFrame(
        [("uno.ar", "Salta", "Salta"), ("dos.ar", "Jujuy", "Perico"), ("tres.ar", "CABA", "CABA")],
        "host string, state string, city string",
    )
    stats, news = extract_articles(
        pages, portals, ["droga"], vectors, "narco", "2023-08-16 10:00:00", threshold=0.4
    )
    assert table(stats, "url", "fail_build", "total_articles", "match1_url", "match2_url_topic_related") == [
        ("dos.ar", False, 1, 1, 1), ("tres.ar", True, 0, 0, 0), ("uno.ar", False, 4, 3, 3)]
    # 1 and 2 are copies, 3 is from yesterday, 4 has no keyword, 5 is too short
    got = news.collect()
    assert [(r["page_id"], r["state"], r["title"], r["authors"]) for r in got] == [(1, "Salta", "T & U", "n-a")]
    assert got[0]["content_nchar"] > 400


def test_batch_leaves_no_tables_between_its_steps(spark, settings, tmp_path):
    """A step's table goes when the next one is written; the rejected rows stay for the caller."""
    before = set(os.listdir(shared_dir(spark)))
    store = ArticleStore(spark, str(tmp_path / "s"))
    broken = [("", "u7", "Salta", DAY1)]
    added, rejected = transform_batch(raw(spark, FIRST + broken), store, settings, 0)
    assert added == 2 and table(rejected, "link", "reason") == [("u7", "no content")]
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(shared_dir(spark))) - before}
    assert left == {"rejected"}
    assert [r[0] for r in table(store.live_news(), "index")] == [1, 2] and store.embeddings().count() == 2


def test_summaries_by_row_equal_those_of_a_joined_summarizer(spark, settings, tmp_path):
    def joined(df, key, text):
        return extractive_summary(df, key, text, stop_words=("la",))

    found = []
    for name, summarize in (("a", joined), ("b", partial(extractive_summary, stop_words=("la",)))):
        store = ArticleStore(spark, str(tmp_path / name))
        transform_batch(raw(spark, FIRST + SECOND), store, replace(settings, summarize=summarize), 0)
        found.append(table(store.live_news(), *schemas.NEWS.names))
    assert found[0] == found[1] and len(found[0]) == 3
