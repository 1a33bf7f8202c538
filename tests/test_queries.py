"""Every registered query against its SQL on the smallest tables."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from pressgauge.operators import topics
from pressgauge.plans.oracle import ORACLE as SQL
from pressgauge.plans.queries import REGISTRY as QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = Counter(result.fetchall())
    got = Counter(tuple(r) for r in df.select(*[F.col(f"`{c}`") for c in columns]).collect())
    assert got == want


def test_only_the_topic_model_has_no_sql():
    assert set(QUERIES) - set(SQL) == {"lda_topics"}


def test_everything_is_registered():
    assert set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).columns[1] == "provincia"


def test_topic_words(spark):
    texts = ["gato perro gato perro gato"] * 20 + ["avion tren avion tren avion"] * 20
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts, vocabulary = topics.bag_of_words(df, "text")
    model = topics.fit_lda(counts, topics=2, iterations=30)
    found = topics.topic_words(model, vocabulary, 2).collect()
    groups = {frozenset(r["term"] for r in found if r["topic"] == t) for t in (0, 1)}
    assert groups == {frozenset({"gato", "perro"}), frozenset({"avion", "tren"})}


def test_lda_runs_the_whole_job(spark, sf_dir, monkeypatch):
    made = []
    fit = topics.fit_lda
    monkeypatch.setattr(topics, "fit_lda", lambda *a, **b: made.append(fit(*a, **b)) or made[-1])
    found = QUERIES["lda_topics"](spark, sf_dir)
    assert made[0].getK() == 122 and made[0].getMaxIter() == 10 and made[0].isDistributed()
    rows = found.collect()
    assert {(r["topic"], r["position"]) for r in rows} == {(t, p) for t in range(122) for p in range(10)}
