"""Preparation of a training corpus in five stages over ``documents``.

Each stage works on all that the stage before it kept. Every stage but the last returns the columns of documents, further
columns of the table included, whatever they are called. A null text is an empty one to every stage and comes through as null:
it is not toxic, all texts without a word are one group of near duplicates, it has no passage, size 0 and no ids. Rows
without an id are kept apart by their text and come last in a group; their texts are neither cut nor do they cut others. Rows with
the same id and text are one document after the second stage. A null source is a source of its own. Texts of any
length are read whole, and an empty table passes every stage as an empty table.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pressgauge.llm import mixing, simhash, substring, subwords, toxicity  # noqa: E402
from pressgauge.llm.lookup import free_name  # noqa: E402
from pressgauge.session import cut_lineage, ship_package  # noqa: E402

PIECES = "piece_bpe_32k.model"
#: SQL for the rows of run(): SQL can't express the classifier, the fingerprints or the merges.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    ship_package(spark)
    chain = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, chain)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links: four-word shingles, four or fewer other bits of the fingerprints."""
    ship_package(spark)
    return simhash.keep_one(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; ``n_chars`` counts what is left."""
    ship_package(spark)
    return substring.cut_texts(docs, length_col="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come near their target weights."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces as ``ids``, or ``ids_1`` and so on where a column has that name."""
    ship_package(spark)
    import public_tokenizers

    codec = subwords.Codec.fit(docs, public_tokenizers.path(PIECES))
    return docs.withColumn(free_name(docs, "ids"), codec.encode(F.col("text")))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
