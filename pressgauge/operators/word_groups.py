"""Texts meet what is known of their words a group at a time.

A row per word of a text is the widest table that word vectors can make: it holds the vector again for every text that has the
word. Here the texts are dealt into groups of some ``GROUP_BYTES``; a group's distinct words meet the lookup once, and its texts and
its part of the lookup come together in one task. What travels is the texts and a row per group and word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressgauge.functions.text import spaced_words
from pressgauge.session import cut_lineage, ship_package

#: Text of a group, about. A task holds one group, the values of its words, and the rows it makes.
GROUP_BYTES = 8 << 20
#: Words whose values are folded at once.
WORDS = 4_096
#: Texts cut into words at once.
ROWS = 1_024

#: (values of the group's words, text and word of each known word of the texts in their order, number of texts) -> columns of the result.
Fold = Callable[[np.ndarray, np.ndarray, np.ndarray, int], list[pa.Array]]


def split_words(spaced: pa.Array) -> pa.ListArray:
    """The words of strings of :func:`pressgauge.functions.text.spaced_words`, with empty ones at the ends; null has one empty word."""
    return pc.split_pattern(pc.fill_null(spaced, ""), " ")


def _group_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_group, _words) to (_of, word): the distinct words of each group in a batch."""
    for batch in batches:
        for a in range(0, len(batch), ROWS):
            part = batch.slice(a, ROWS)
            cut = split_words(part.column(1))
            words = cut.flatten().dictionary_encode()
            groups, at = np.unique(part.column(0).to_numpy(), return_inverse=True)
            of = np.repeat(at, pc.list_value_length(cut).to_numpy())
            size = max(1, len(words.dictionary))
            group, word = np.divmod(np.unique(of * size + words.indices.to_numpy()), size)
            yield pa.RecordBatch.from_arrays([pa.array(groups[group]), words.dictionary.take(pa.array(word))], names=["_of", "word"])


def count_words(spaced: DataFrame) -> DataFrame:
    """(word, n) of all words of a column of :func:`pressgauge.functions.text.spaced_words`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), ROWS):
                counted = split_words(batch.column(0).slice(a, ROWS)).flatten().value_counts()
                yield pa.RecordBatch.from_arrays(counted.flatten(), names=["word", "n"])

    ship_package(spaced.sparkSession)
    part = spaced.mapInArrow(run, "word string, n bigint").filter(F.col("word") != "")
    return part.groupBy("word").agg(F.sum("n").alias("n"))


def row_groups(df: DataFrame, text: str) -> Column:
    """A group number for the rows of ``df`` by the average length of their texts; it is to be written at once.

    Rows lie together as they are read, so a group's words are combined in the task that has it.
    """
    total, count = df.agg(F.sum(F.octet_length(text)), F.count(F.lit(1))).first()
    rows = max(1, count * GROUP_BYTES // max(1, total or 0))
    return F.floor(F.monotonically_increasing_id() / F.lit(rows)).cast("bigint")


def fold_runs(ufunc: np.ufunc, rows: np.ndarray, of: np.ndarray, places: np.ndarray, out: np.ndarray, words: int = WORDS) -> None:
    """Fold ``rows[places]`` into ``out`` by the texts ``of``, which ascend; so many words at once, however long a text is."""
    for a in range(0, len(of), words):
        part = of[a : a + words]
        begins = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        at = part[begins]
        out[at] = ufunc(out[at], ufunc.reduceat(rows[places[a : a + words]], begins, axis=0))


def rows_of(lists: pa.ChunkedArray) -> np.ndarray:
    """Lists of equal length as a matrix; null elements are NaN."""
    if not len(lists):
        return np.zeros((0, 0))
    return pc.list_flatten(lists).combine_chunks().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def lists_of(rows: np.ndarray, null: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists; elements are null where ``null`` says so."""
    ends = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(rows.ravel(), mask=null.ravel()))


@dataclass(frozen=True)
class WordGroups:
    """Texts (_group, _key, _words) as a written table, and (_of, word, values) for the known words of each group."""

    key: T.StructField
    texts: DataFrame
    values: DataFrame
    together: bool

    @staticmethod
    def of(
        df: DataFrame, key: str, text: str, lookup: DataFrame, stop_words: Sequence[str] = (), together: bool = False
    ) -> WordGroups:
        """``lookup`` is (word, values), each word once, lists of equal length. Stop words have no values.

        With ``together`` the texts of one key are in one group, so a key should not repeat often.
        """
        ship_package(df.sparkSession)
        plain = df.select(F.col(key).alias("_key"), spaced_words(F.col(text)).alias("_words"))
        if together:
            total = df.agg(F.sum(F.octet_length(text))).first()[0] or 1
            group = F.pmod(F.xxhash64("_key"), F.lit(-(-total // GROUP_BYTES))).cast("bigint")
        else:
            group = row_groups(df, text)
        texts = cut_lineage(plain.withColumn("_group", group), "texts")
        found = texts.select("_group", "_words").mapInArrow(_group_words, "_of bigint, word string").distinct()
        known = lookup.filter(~F.col("word").isin("", *stop_words))
        return WordGroups(df.schema[key], texts, found.join(known, "word").select("_of", "word", "values"), together)

    def fold(self, fold: Fold, fields: Sequence[T.StructField]) -> DataFrame:
        """(key, fields): one row per text, or with ``together`` per key, from the values of its words; every repeat of a word is handed on."""
        together, names = self.together, [self.key.name, *(f.name for f in fields)]

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            keys = left.column("_key").combine_chunks()
            cut = split_words(left.column("_words").combine_chunks())
            places = pc.index_in(cut.flatten(), value_set=right.column("word").combine_chunks())
            of = np.repeat(np.arange(len(cut)), pc.list_value_length(cut).to_numpy())
            mask = places.is_valid().to_numpy(zero_copy_only=False)
            of, places = of[mask], places.drop_null().to_numpy()
            if together:
                same = keys.dictionary_encode(null_encoding="encode")
                keys, of = same.dictionary, same.indices.to_numpy()[of]
                order = np.argsort(of, kind="stable")
                of, places = of[order], places[order]
            return pa.Table.from_arrays([keys, *fold(rows_of(right.column("values")), of, places, len(keys))], names=names)

        schema = T.StructType([T.StructField(self.key.name, self.key.dataType), *fields])
        return self.texts.groupBy("_group").cogroup(self.values.groupBy("_of")).applyInArrow(run, schema)
