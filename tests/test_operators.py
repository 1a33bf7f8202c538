from itertools import pairwise

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressgauge.operators import chunks, clean, dedupe, embed, entities, ids, report, summarize
from pressgauge.operators.skew import counted_join, skewed_join


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_hot_key_survives_every_duplicate_operator(spark):
    # a third of all rows shares one key
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    assert dedupe.keep_first(df, "k", "id").count() == 2001
    assert dedupe.unduplicated(df, "k", "id").count() == 2000
    flagged = dedupe.duplicate_flag(df, "k")
    assert flagged.count() == 3000
    assert flagged.filter("copies = 1000 and duplicated").count() == 1000
    store = spark.createDataFrame([("hot",), ("1",)], "k string")
    assert dedupe.remove_known(df, store, "k").count() == 1999


def test_remove_known_keeps_copies_inside_the_batch(spark):
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, content_hash string")
    store = spark.createDataFrame([("a",)], "content_hash string")
    assert rows(dedupe.remove_known(batch, store), "id") == [(2,), (3,)]
    assert dedupe.remove_known(batch, store.limit(0)).count() == 3


def test_counted_join_near_and_far_rows(spark):
    df = spark.range(4000).select(
        "id", F.when(F.col("id") % 4 == 0, None).when(F.col("id") % 4 == 1, "hot")
        .otherwise(F.col("id").cast("string")).alias("k"))
    counts = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = counted_join(df, counts, "k", "n", max_hot=100)
    assert got.count() == 4000
    assert rows(got.groupBy("n").count(), "n", "count") == [(1, 2000), (1000, 2000)]
    assert got.filter("k is null and n = 1000").count() == 1000


def test_skewed_join_kinds_match_plain_joins(spark):
    big = spark.range(600).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "loose")
        .when(F.col("id") < 9, None).otherwise(F.col("id").cast("string")).alias("k"))
    lookup = spark.createDataFrame([("hot", 1), ("11", 2), ("14", 3), ("none", 4), ("11", 5), ("hot", 6)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        for max_hot in (1, 10, 100_000):
            got = skewed_join(big, lookup, "k", how, max_hot)
            want = big.join(lookup, "k", how).select(*got.columns)
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_consolidate_news(spark):
    news = spark.createDataFrame(
        [(3, "h1", "a"), (1, "h1", "b"), (2, "h2", "b"), (4, "h3", "c")],
        "index bigint, content_hash string, link string",
    )
    assert rows(dedupe.consolidate_news(news), "index") == [(1,), (4,)]


def test_consolidate_entities(spark):
    ner = spark.createDataFrame(
        [
            (1, "PER", 0.5, "Ana, Paz", 9), (1, "LOC", 0.9, "Ana  Paz", 3), (1, "ORG", 0.9, "Ana Paz.", 5),
            (1, "MISC", 0.9, "¡!", 1), (2, "PER", 0.1, "Ana Paz", 0),
        ],
        "index bigint, entity_group string, score double, word string, start int",
    )
    got = rows(dedupe.consolidate_entities(ner), "index", "word", "entity_group", "start")
    assert got == [(1, "Ana  Paz", "LOC", 3), (1, "Ana Paz", "ORG", 5), (2, "Ana Paz", "PER", 0)]


def test_ids_are_consecutive_from_start(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), F.hash("id").alias("h"))
    got = ids.assign_ids(df, ["h", "k"], start=10)
    assert got.count() == 5000
    in_order = [r["index"] for r in got.orderBy("h", "k").collect()]
    assert in_order == list(range(10, 5010))


def test_next_index_of_empty_store(spark):
    assert ids.next_index(spark.createDataFrame([], "index bigint")) == 1
    assert ids.next_index(spark.createDataFrame([(7,), (3,)], "index bigint")) == 8


def test_fixed_chunks(spark):
    letters = "".join(chr(97 + i % 26) for i in range(1000))
    df = spark.createDataFrame([(letters,), ("x" * 400,), ("x" * 401,), ("x" * 740,), ("",)], "t string")
    got = [r["c"] for r in df.select(chunks.fixed_chunks(F.col("t")).alias("c")).collect()]
    assert [c["start"] for c in got[0]] == [1, 341, 681]
    assert all(c["chunk"] == letters[c["start"] - 1 : c["start"] + 399] for c in got[0])
    assert [len(c) for c in got] == [3, 1, 2, 2, 0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 900), max_size=60), st.integers(20, 400))
def test_word_chunks_cover_the_text(lengths, size):
    overlap = size // 6
    text = " ".join("w" * n for n in lengths)
    got = chunks._cut_at_words(text, size, overlap)
    covered = 0
    for c in got:
        begin = c["start"] - 1
        assert 0 < len(c["chunk"]) <= size
        assert text[begin : begin + len(c["chunk"])] == c["chunk"]
        assert text[covered:begin].strip() == ""
        assert begin + len(c["chunk"]) > covered
        covered = begin + len(c["chunk"])
    assert text[covered:].strip() == ""
    for a, b in pairwise(got):
        shared = a["start"] + len(a["chunk"]) - b["start"]
        assert shared <= overlap


def test_word_chunks_against_recount():
    text = "ab " * 200
    got = chunks._cut_at_words(text.strip(), 400, 60)
    assert [(c["start"], len(c["chunk"])) for c in got] == [(1, 398), (340, 260)]


def test_rule_entities_offsets(spark):
    filler = "palabra " * 60
    text = f"Juan Perez vio a ANSES en Cordoba. {filler}Maria Lopez uso 10.0.0.1 y a.b@c.org"
    df = spark.createDataFrame([(1, text), (2, "nada aqui"), (3, "")], "index bigint, content string")
    found = entities.rule_entities(df, "content").collect()
    assert {r["index"] for r in found} == {1}
    for r in found:
        assert text[r["doc_start"] : r["doc_start"] + len(r["word"])] == r["word"]
        assert r["end"] - r["start"] == len(r["word"])
    got = {(r["entity_group"], r["word"]) for r in found}
    assert {("PER", "Juan Perez"), ("PER", "Maria Lopez"), ("ORG", "ANSES"), ("LOC", "Cordoba"),
            ("MISC", "10.0.0.1"), ("MISC", "a.b@c.org")} <= got


def test_article_without_entities_first(spark):
    df = spark.createDataFrame(
        [(1, "sin nombres"), (2, "Juan Perez, Ana Paz")], "index bigint, content string"
    )
    people = entities.rule_entities(df, "content").filter("entity_group = 'PER'")
    assert rows(people, "index", "word") == [(2, "Ana Paz"), (2, "Juan Perez")]


def test_gazetteer(spark):
    filler = "ñ" * 360
    df = spark.createDataFrame(
        [(1, "el Banco  Central de Salta, Salta"), (2, filler + " Policia Federal de Argentina Norte, fin" + " x" * 300), (3, None)],
        "index bigint, content string",
    )
    gazetteer = spark.createDataFrame(
        [("Banco Central", "ORG", 1.0), ("Salta", "LOC", 0.9), ("Salta", "ORG", 0.5), ("Jujuy", "LOC", 0.9),
         ("Policia Federal de Argentina Norte", "ORG", 1.0)],
        "word string, entity_group string, score double",
    )
    got = rows(entities.gazetteer_entities(df, "content", gazetteer), "index", "entity_group", "word", "start", "end")
    assert got == [
        (1, "LOC", "Salta", 20, 25), (1, "LOC", "Salta", 27, 32), (1, "ORG", "Banco Central", 3, 16),
        (1, "ORG", "Salta", 20, 25), (1, "ORG", "Salta", 27, 32),
        (2, "ORG", "Policia Federal de Argentina Norte", 361, 395),
    ]


def test_summary_keeps_text_order_and_cap(spark):
    text = "Uno dos. Gato gato perro. Perro gato. Nada igual aqui. Gato solo."
    df = spark.createDataFrame([(1, text), (2, ""), (3, "123. 456.")], "id int, t string")
    got = dict(rows(summarize.extractive_summary(df, "id", "t", top=2), "id", "summary"))
    assert got == {1: "Gato gato perro. Perro gato.", 2: "", 3: ""}
    capped = dict(rows(summarize.extractive_summary(df, "id", "t", top=2, max_words=1), "id", "summary"))
    assert capped[1] == "Gato gato perro."


def test_summary_is_local_to_a_row_and_keeps_decimal_points(spark):
    df = spark.createDataFrame([(1, "¡Ojo! Subio 3.5 por ciento. ...y bajo. " + "1." * 9000), (2, None)], "id int, t string")
    assert one_list(spark, df, 1)[:3] == ["¡Ojo!", "Subio 3.5 por ciento.", "...y bajo."]
    found = summarize.extractive_summary(df, "id", "t", stop_words=("por",))
    assert dict(rows(found, "id", "summary")) == {1: "¡Ojo! Subio 3.5 por ciento. ...y bajo.", 2: ""}
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def one_list(spark, df, key):
    return df.filter(F.col("id") == key).select(summarize.sentences(F.col("t")).alias("s")).first()["s"]


def test_mean_vector_and_backfill(spark):
    vectors = spark.createDataFrame(
        [(0, "a", [1.0, 0.0]), (1, "b", [0.0, 1.0])], "rank bigint, word string, vec array<float>"
    )
    news = spark.createDataFrame(
        [(1, "a a b z"), (2, "z"), (3, "b"), (4, None)], "index bigint, tit_summary string"
    )
    got = {r["index"]: r["embeddings"] for r in embed.mean_word_vector(news, "index", "tit_summary", vectors, 2).collect()}
    assert [round(v, 4) for v in got[1]] == [0.6667, 0.3333]
    assert got[2] is None and got[4] is None
    done = spark.createDataFrame([(3,)], "index bigint")
    assert [r["index"] for r in embed.backfill(news, done, vectors, 2).collect()] == [1]


def test_length_filter_and_rejects(spark):
    df = spark.createDataFrame([(400,), (401,)], "content_nchar int")
    assert rows(clean.long_enough(df), "content_nchar") == [(401,)]
    raw = spark.createDataFrame(
        [("t", "2023-08-16 13:55:01", "2023-08-16"), ("t", "2023-13-01 10:00:00", None),
         ("", "2023-08-16 13:55:01", None), ("t", "2023-08-16 13:55:01", "ayer")],
        "content string, date_extract string, date_article string",
    )
    good, bad = clean.split_rejects(raw)
    assert good.count() == 1
    assert rows(bad, "reason") == [("bad date_article",), ("bad date_extract",), ("no content",)]


def test_same_day_and_usable(spark):
    df = spark.createDataFrame([("2023-08-16 10:00:00",), ("2023-08-15 23:59:59",)], "date_article string")
    assert clean.same_day(df, "2023-08-16").count() == 1
    links = spark.createDataFrame([("t", "https://a/b"), ("", "https://a/b"), ("t", "a/b")], "t string, l string")
    assert links.filter(clean.usable("t", "l")).count() == 1


def _report_input(spark):
    news = spark.createDataFrame(
        [(1, "Salta"), (2, "Salta"), (3, "Salta"), (4, "Jujuy"), (5, "Jujuy"), (6, "Argentina"), (7, None)],
        "index bigint, state string",
    )
    ner = spark.createDataFrame(
        [(4, "PER", "Ana Paz")] * 5 + [(6, "PER", "Otro Mas"), (7, "PER", "Otro Mas")],
        "index bigint, entity_group string, word string",
    )
    return news, ner


def test_province_stats_total_and_absent_groups(spark):
    got = [tuple(r) for r in report.province_stats(*_report_input(spark)).orderBy("pos").collect()]
    assert got == [
        (1, "Salta", 3, None, None, None, None),
        (2, "Jujuy", 2, 5, None, None, None),
        (3, "Total", 5, 5, None, None, None),
    ]
    assert report.chart_input(report.province_stats(*_report_input(spark))).count() == 2


def test_person_filter(spark):
    words = ["Juan Perez", "Juan", "12 34", "1234"]
    ner = spark.createDataFrame([(1, "PER", w) for w in words] + [(1, "LOC", "Villa Luro")],
                                "index bigint, entity_group string, word string")
    assert rows(report.persons(ner), "word") == [("12 34",), ("Juan Perez",)]


def test_person_network_parts_rebuild_the_list(spark):
    ner = spark.range(2500).select(
        F.col("id").alias("index"), F.lit("PER").alias("entity_group"), F.lit("Juan Perez").alias("word")
    )
    parts = report.person_network(ner, articles_per_part=1000).orderBy("part").collect()
    assert [len(p["articles"]) for p in parts] == [1000, 1000, 500]
    assert sum((p["articles"] for p in parts), []) == list(range(2500))
    assert {p["occurrences"] for p in parts} == {2500}


def test_network(spark):
    ner = spark.createDataFrame(
        [(1, "PER", "A B"), (2, "PER", "A B"), (2, "PER", "C D"), (3, "PER", "E F")],
        "index bigint, entity_group string, word string",
    )
    edges = report.network_edges(ner, 2)
    assert rows(edges, "word", "article") == [("A B", "1"), ("A B", "2"), ("C D", "2")]
    assert rows(report.network_nodes(edges), "node", "type") == [
        ("1", "article"), ("2", "article"), ("A B", "word"), ("C D", "word")]


def test_entity_table(spark):
    ner = spark.createDataFrame(
        [(1, "PER", "b"), (1, "PER", "a"), (1, "LOC", "x"), (2, "ORG", "o")],
        "index bigint, entity_group string, word string",
    )
    assert sorted(map(tuple, report.entity_table(ner).collect())) == [
        (1, "a; b", "x", None, None), (2, None, None, "o", None)]


def test_model_entities_hook(spark):
    # local functions travel to the workers by value
    def load():
        def recognise(texts):
            found = []
            for t in texts:
                at = t.find("ANSES")
                hit = {"entity_group": "ORG", "score": 1.0, "word": "ANSES", "start": at, "end": at + 5}
                found.append([hit] if at >= 0 else [])
            return found

        return recognise

    text = "relleno " * 60 + "ANSES fin"
    df = spark.createDataFrame([(1, text), (2, "nada")], "index bigint, content string")
    got = entities.model_entities(df, "content", load).collect()
    assert [(r["index"], r["chunk_id"], r["word"]) for r in got] == [(1, 1, "ANSES")]
    assert text[got[0]["doc_start"] :].startswith("ANSES")
    same = entities.rule_entities(df, "content").filter("word = 'ANSES'")
    assert rows(same, "doc_start", "start", "end") == rows(
        entities.model_entities(df, "content", load), "doc_start", "start", "end")


def test_model_vectors_hook(spark):
    def load():
        import numpy as np

        return lambda texts: np.array([[len(t), 1.0] for t in texts], dtype="float32")

    df = spark.createDataFrame([(1, "abc"), (2, None)], "index bigint, t string")
    got = {r["index"]: r["embeddings"] for r in embed.model_vectors(df, "index", "t", load).collect()}
    assert got == {1: [3.0, 1.0], 2: None}


def test_long_separator_runs(spark):
    from pressgauge.functions.text import clean_whitespace, word_count, words

    df = spark.createDataFrame([("a" + " -" * 200_000 + "b",)], "t string")
    got = df.select(words(F.col("t")).alias("w"), word_count(F.col("t")).alias("n"), clean_whitespace(F.col("t")).alias("c")).first()
    assert got["w"] == ["a", "b"] and got["n"] == 200_001 and len(got["c"]) == 400_002
