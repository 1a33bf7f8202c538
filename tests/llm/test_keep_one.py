"""One row of each group of near duplicates, without a shuffle of the texts."""

from collections import Counter

import pytest

from pressgauge.llm import simhash

A, B = "uno dos tres cuatro cinco seis siete", "one two three four five six seven eight"
ROWS = [(1, A), (2, A), (3, B), (3, B), (4, B), (None, A), (None, "sin par ni copia alguna en la tabla"), (None, "sin par ni copia alguna en la tabla"), (5, None), (6, " "), (7, "otro texto que nadie mas tiene aqui")]
WANT = Counter([(1, A), (3, B), (None, "sin par ni copia alguna en la tabla"), (5, None), (7, "otro texto que nadie mas tiene aqui")])


@pytest.mark.parametrize("most", [simhash.MAX_BROADCAST_KEYS if hasattr(simhash, "MAX_BROADCAST_KEYS") else 0, -1])
def test_one_row_of_each_group(spark, monkeypatch, most):
    monkeypatch.setattr(simhash, "MAX_BROADCAST_KEYS", most, raising=False)
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(3)
    assert Counter(tuple(r) for r in simhash.keep_one(docs).collect()) == WANT


def test_texts_meet_the_few_other_keys_without_a_shuffle(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = simhash.keep_one(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "LeftAnti" in plan
