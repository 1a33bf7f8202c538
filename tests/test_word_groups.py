"""Words that meet their vectors by groups of texts, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from pressgauge.functions.text import spaced_words, words
from pressgauge.operators import chunks, embed, entities, keyword_blocks, relevance, word_groups


def cosine(a, b):
    size = lambda v: sum(x * x for x in v) ** 0.5
    return sum(x * y for x, y in zip(a, b)) / size(a) / size(b)


def sample(spark):
    """Texts of which some share an id or have none; a word with two vectors and one with a null element."""
    rng = random.Random(5)
    known = {f"palabra{c}": [[rng.uniform(-1, 1) for _ in range(3)]] for c in "abcdefghij"}
    known["doble"] = [[1.0, 2.0, 3.0], [3.0, 2.0, 2.0]]
    texts = [(i // 2 if i < 20 else i, " ".join(rng.choices([*known, "otra", "la"], k=rng.randint(1, 40)))) for i in range(60)]
    texts += [(None, "Palabraa, DOBLE"), (None, "palabrab 7 palabrab"), (900, None), (901, "... 12"), (902, "la otra")]
    vectors = [(rank, w, v) for rank, (w, vs) in enumerate(known.items()) for v in vs]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    return df, texts, known, spark.createDataFrame([*vectors, (99, "la", [9.0] * 3)], "rank bigint, word string, vec array<float>")


def words_of(texts):
    found = {}
    for key, text in texts:
        found.setdefault(key, []).extend((text or "").lower().replace(",", "").split())
    return found


@pytest.fixture(params=[8 << 20, 100])
def group_bytes(request, monkeypatch):
    monkeypatch.setattr(word_groups, "GROUP_BYTES", request.param)


def test_mean_vectors(spark, group_bytes):
    df, texts, known, vectors = sample(spark)
    got = {r["doc_id"]: r["embeddings"] for r in embed.mean_word_vector(df, "doc_id", "text", vectors, 3, ("la",)).collect()}
    want = {}
    for key, own in words_of(texts).items():
        of = [v for w in own for v in known.get(w, [])]
        want[key] = [sum(x) / len(of) for x in zip(*of)] if of else None
    assert got.keys() == want.keys()
    for key, mean in want.items():
        assert got[key] == (pytest.approx(mean, abs=1e-5) if mean else None)


def test_null_elements_and_vectors(spark):
    texts = spark.createDataFrame([(1, "uno dos"), (2, "dos"), (3, "nada")], "doc_id int, text string")
    vectors = spark.createDataFrame([(0, "uno", [1.0, None]), (1, "dos", [3.0, None]), (2, "nada", None)], "rank int, word string, vec array<float>")
    got = {r["doc_id"]: r["embeddings"] for r in embed.mean_word_vector(texts, "doc_id", "text", vectors, 2).collect()}
    assert got == {1: [2.0, None], 2: [3.0, None], 3: None}


def test_similarities(spark, group_bytes):
    df, texts, known, vectors = sample(spark)
    keywords = ["palabraa", "falta", "palabrac"]
    got = {r["doc_id"]: r["best"] for r in relevance.keyword_similarities(df, "doc_id", "text", keywords, vectors, ("la",)).collect()}
    for key, own in words_of(texts).items():
        of = [v for w in own for v in known.get(w, [])]
        want = [max(cosine(v, known[k][0]) if k in known else 0.0 for v in of) if of else None for k in keywords]
        assert got[key] == pytest.approx(want, abs=1e-5)


def test_what_travels_grows_with_the_groups_words_and_not_with_the_texts_words(spark):
    """A row per word and text held the vector each time: 400 texts with the same 50 words made 20,000 of them."""
    names = [f"voz{a}{b}" for a in "abcde" for b in "abcdefghij"]
    vectors = spark.createDataFrame([(i, w, [float(i % 7), 1.0]) for i, w in enumerate(names)], "rank int, word string, vec array<float>")
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.lit(" ".join(names)).alias("text"))
    lookup = vectors.select("word", F.col("vec").cast("array<double>").alias("values"))
    groups = word_groups.WordGroups.of(df, "doc_id", "text", lookup, together=True)
    assert groups.texts.count() == 400 and groups.values.count() == 50
    keywords = spark.createDataFrame([(names[3],)], "keyword string")
    assert {r["score"] for r in keyword_blocks.similarity_to_many(df, "doc_id", "text", keywords, vectors).collect()} == {1.0}


def test_spaced_words_are_the_words(spark):
    rows = ["", None, "Ver https://a.b/c, 3 veces ÉL", "  x--y  ", "ñandú٣ 4five"]
    df = spark.createDataFrame([(t,) for t in rows], "text string")
    both = df.select(words(F.col("text")).alias("a"), F.array_remove(F.split(spaced_words(F.col("text")), " "), "").alias("b")).collect()
    assert [r["a"] for r in both] == [r["b"] for r in both]
    counted = {r["word"]: r["n"] for r in word_groups.count_words(df.select(spaced_words(F.col("text")))).collect()}
    want = {}
    for r in both:
        for w in r["a"] or ():
            want[w] = want.get(w, 0) + 1
    assert counted == want


def test_gazetteer_runs_in_groups(spark, group_bytes):
    """Only runs of words that stand in names are made, the others are not even looked up."""
    texts = [(1, "Ana Paz, Ana Paz Ruiz y Ana."), (2, None), (3, "Paz Ana ana Ruiz"), (3, "Ruiz Ana -- Paz"), (None, "Ana_Paz Ana  Paz")]
    names = [("Ana Paz", "PER", 1.0), ("Ruiz", "LOC", 0.5), ("Ruiz", "PER", 0.4), ("Ana Paz Ruiz", "PER", 1.0), ("y  Ana", "PER", 1.0), (None, "PER", 1.0)]
    df = spark.createDataFrame(texts, "index int, content string").repartition(2)
    gazetteer = spark.createDataFrame(names, "word string, entity_group string, score double")
    got = entities.gazetteer_entities(df, "content", gazetteer).collect()
    want = [
        (1, "PER", 1.0, "Ana Paz", 0, 7), (1, "PER", 1.0, "Ana Paz", 9, 16), (1, "PER", 1.0, "Ana Paz Ruiz", 9, 21),
        (1, "LOC", 0.5, "Ruiz", 17, 21), (1, "PER", 0.4, "Ruiz", 17, 21), (3, "LOC", 0.5, "Ruiz", 12, 16), (3, "PER", 0.4, "Ruiz", 12, 16),
        (3, "LOC", 0.5, "Ruiz", 0, 4), (3, "PER", 0.4, "Ruiz", 0, 4), (3, "PER", 1.0, "Ana Paz", 5, 15), (None, "PER", 1.0, "Ana Paz", 8, 15),
    ]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_chunks_in_small_parts(spark, monkeypatch):
    """A batch of 10,000 texts held all its chunks as Python objects."""
    monkeypatch.setattr(chunks, "CHARACTERS", 300)
    texts = [(i, None if i % 7 == 0 else "uno dos tres cuatro " * (i % 9)) for i in range(50)]
    df = spark.createDataFrame(texts, "i int, t string").coalesce(1)
    got = {r["i"]: r["c"] and [tuple(c) for c in r["c"]] for r in df.select("i", chunks.word_chunks(F.col("t"), 50, 10).alias("c")).collect()}
    assert got == {i: None if t is None else [(c["start"], c["chunk"]) for c in chunks._cut_at_words(t, 50, 10)] for i, t in texts}
