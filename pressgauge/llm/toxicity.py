"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other. Each model is a logistic regression on bare words and word
beginnings that occur in the text, and on the probabilities of the categories before it. For fitting,
those probabilities come from models that have not seen the row (folds by CRC-32 of the id); for
scoring, from the models fitted on all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from pressgauge.llm.sample import labelled_sample
from pressgauge.llm.scan import NOT_LETTER, Words, mix, pieces, utf8
from pressgauge.session import cut_lineage

#: The chain: name and SQL condition over the columns of a label row.
CATEGORIES = (("low_quality", "quality = 0"), ("toxic_prose", "toxic = 1 AND quality = 1"), ("toxic", "toxic = 1"))
#: At most this many labelled rows are fitted on.
SAMPLE_ROWS = 10_000
FOLDS = 3
#: Word beginnings of so many bytes are features beside whole words.
BEGINNINGS = (4, 5, 6)
#: A feature is used if at least so many sampled rows have it and its chi-squared is above the limit (0.1 %).
LEAST_ROWS = 5
LEAST_CHI2 = 10.83
THRESHOLD = 0.5
_STEPS, _RATE, _RIDGE = 150, 0.15, 2e-4
_FILTER_BITS = 20


def _features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, feature) for each word and kind of feature; pairs repeat."""
    words = Words(texts, NOT_LETTER, lower=True)
    of, lengths = words.texts_of(), words.ends - words.starts
    yield of, words.hashes()
    for n in BEGINNINGS:
        long = lengths > n
        yield of[long], mix(words.hashes(n)[long] + np.uint64(n))


@dataclass
class Link:
    """One model of the chain: sorted features, their weights, the weights of earlier probabilities."""

    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def logits(self, rows: np.ndarray, at: np.ndarray, n: int, before: np.ndarray) -> np.ndarray:
        """For ``n`` rows, from (row, index of a feature) pairs and the probabilities ``before``."""
        total = np.bincount(rows, self.weights[at], minlength=n) if len(rows) else np.zeros(n)
        return total + before @ self.earlier + self.bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _fit_link(
    kinds: np.ndarray, rows: np.ndarray, index: np.ndarray, before: np.ndarray, y: np.ndarray
) -> Link:
    """Choose features (``kinds[index]``) by chi-squared and fit by gradient steps (Adam) over all rows."""
    n, positives = len(y), y.sum()
    has = np.bincount(index, minlength=len(kinds))
    hit = np.bincount(index, y[rows], minlength=len(kinds))
    share = positives / max(1, n)
    expected = has * share
    spread = expected * (1 - share) * (1 - has / max(1, n)) + 1e-9
    chi2 = np.where(has >= LEAST_ROWS, (hit - expected) ** 2 / spread, 0)
    chosen = np.flatnonzero(chi2 > LEAST_CHI2)
    place = np.full(len(kinds), -1)
    place[chosen] = np.arange(len(chosen))
    keep = place[index] >= 0
    r, f = rows[keep], place[index[keep]]
    size = len(chosen)
    link = Link(kinds[chosen], np.zeros(size), np.zeros(before.shape[1]), 0.0)
    if not 0 < positives < n:
        link.bias = 20.0 if positives else -20.0
        return link
    link.bias = float(np.log(positives / (n - positives)))
    theta = np.concatenate((link.weights, link.earlier, [link.bias]))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, _STEPS + 1):
        link.weights, link.earlier, link.bias = theta[:size], theta[size:-1], theta[-1]
        off = (_sigmoid(link.logits(r, f, n, before)) - y) / n
        slope = np.concatenate((np.bincount(f, off[r], minlength=size), off @ before, [off.sum()]))
        slope[:-1] += _RIDGE * theta[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        theta = theta - _RATE * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    link.weights, link.earlier, link.bias = theta[:size], theta[size:-1], float(theta[-1])
    return link


def _pairs(link: Link, rows: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index of the link's feature), each once."""
    if not len(link.features) or not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(link.features, features)
    at[at == len(link.features)] = 0
    same = link.features[at] == features
    code = np.unique(rows[same] * np.int64(len(link.features)) + at[same])
    return np.divmod(code, len(link.features))


class Chain:
    """Fitted models in the order of their categories."""

    def __init__(self, names: list[str]):
        self.names = names
        self.links: list[Link] = []

    def fit(self, kinds: np.ndarray, rows: np.ndarray, index: np.ndarray, labels: np.ndarray, folds: np.ndarray) -> Chain:
        """Distinct pairs of a row and a feature (``kinds[index]``, sorted); ``labels`` has a column per category."""
        n = len(labels)
        before = np.zeros((n, 0))
        for c in range(labels.shape[1]):
            y, unseen = labels[:, c], np.zeros(n)
            for fold in range(FOLDS):
                inside = folds != fold
                new = np.cumsum(inside) - 1
                at = inside[rows]
                link = _fit_link(kinds, new[rows[at]], index[at], before[inside], y[inside])
                r, f = _pairs(link, rows[~at], kinds[index[~at]])
                unseen += np.where(inside, 0, _sigmoid(link.logits(r, f, n, before)))
            self.links.append(_fit_link(kinds, rows, index, before, y))
            before = np.column_stack((before, unseen))
        used = np.concatenate([x.features for x in self.links])
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[used & np.uint64((1 << _FILTER_BITS) - 1)] = True
        return self

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities: a row per text, a column per category."""
        found = [
            (of[may], f[may])
            for of, f in _features(texts)
            for may in [self.filter[f & np.uint64((1 << _FILTER_BITS) - 1)]]
        ]
        rows = np.concatenate([x for x, _ in found])
        features = np.concatenate([x for _, x in found])
        before = np.zeros((len(texts), 0))
        for link in self.links:
            r, f = _pairs(link, rows, features)
            p = _sigmoid(link.logits(r, f, len(texts), before))
            before = np.column_stack((before, p))
        return before


def _telling(found: DataFrame, categories: int) -> DataFrame:
    """(f): features that enough rows have and whose chi-squared is high for some category, over all rows or those outside some fold.

    The models choose among them by the same measure, each for its own rows.
    """
    sums = [F.count_if(F.col("_fold") == v).alias(f"n{v}") for v in range(FOLDS)]
    sums += [F.coalesce(F.sum(F.when(F.col("_fold") == v, F.col(f"_y{c}"))), F.lit(0.0)).alias(f"y{c}_{v}") for c in range(categories) for v in range(FOLDS)]
    total = found.agg(*sums).first()
    counted = found.select(F.explode("features").alias("f"), "_fold", *[f"_y{c}" for c in range(categories)]).groupBy("f").agg(*sums)

    def inside(name: str, apart: int | None, of=None):
        """Of all folds but one: the column's sum, or that of the totals."""
        values = [F.col(f"{name}{v}") if of is None else of[f"{name}{v}"] for v in range(FOLDS) if v != apart]
        return sum(values[1:], values[0])

    tells = F.lit(False)
    for apart in (None, *range(FOLDS)):
        n, has = inside("n", apart, total), inside("n", apart)
        for c in range(categories):
            share = inside(f"y{c}_", apart, total) / max(1, n)
            expected = has * F.lit(float(share))
            spread = expected * (1 - share) * (1 - has / max(1, n)) + 1e-9
            off = inside(f"y{c}_", apart) - expected
            # A little below the limit, for sums that differ in their last digits.
            tells = tells | ((has >= LEAST_ROWS) & (off * off / spread > 0.999 * LEAST_CHI2))
    return counted.filter(tells).select("f")


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, categories=CATEGORIES, id_col: str = "doc_id"
) -> Chain:
    """Fit on at most ``rows`` labelled documents; a null label counts as no. Without any row every probability is about 0.

    Spark counts the features of the sample per fold and category, and the driver gets only those that tell something about a category, first
    as values and then as numbers per row. What it holds is bounded by the sample.
    """
    marks = [F.coalesce(F.expr(condition), F.lit(False)).cast("double").alias(f"_y{i}") for i, (_, condition) in enumerate(categories)]
    chosen = labelled_sample(docs, labels, rows, id_col=id_col)
    fold = (F.crc32(F.col(id_col).cast("string")) % FOLDS).alias("_fold")
    narrow = chosen.select("text", fold, *marks)
    out = StructType([StructField("features", ArrayType(LongType())), *narrow.schema.fields[1:]])
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(0))
            for a, b in pieces(texts):
                lists: list[list] = [[] for _ in range(a, b)]
                for of, f in _features(texts[a:b]):
                    for i, part in enumerate(np.split(f, np.searchsorted(of, np.arange(1, b - a)))):
                        lists[i].append(part)
                each = [np.unique(np.concatenate(x)).view(np.int64) for x in lists]
                column = pa.array(each, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([column, *(batch.column(i).slice(a, b - a) for i in range(1, batch.num_columns))], schema=schema)

    found = cut_lineage(narrow.mapInArrow(run, out), "features")
    telling = _telling(found, len(categories))
    kinds = np.sort(telling.toArrow().column("f").to_numpy().view(np.uint64))
    shared = docs.sparkSession.sparkContext.broadcast(kinds)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            values = lists.flatten().to_numpy().view(np.uint64)
            of = np.repeat(np.arange(len(batch)), [len(x) for x in lists])
            at = np.searchsorted(shared.value, values)
            same = np.zeros(len(at), bool)
            inside = at < len(shared.value)
            same[inside] = shared.value[at[inside]] == values[inside]
            sizes = np.bincount(of[same], minlength=len(batch))
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(at[same].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([column, *batch.columns[1:]], schema=numbers)

    whole = StructType([StructField("features", ArrayType(IntegerType())), *narrow.schema.fields[1:]])
    numbers = to_arrow_schema(whole)
    table = found.mapInArrow(number, whole).toArrow().combine_chunks()
    shared.destroy()
    chain = Chain([name for name, _ in categories])
    if not len(table):
        return chain.fit(kinds, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, len(categories))), np.zeros(0, np.int64))
    lists = table.column("features").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    y = np.column_stack([table.column(f"_y{i}").to_numpy() for i in range(len(categories))])
    index = lists.flatten().to_numpy().astype(np.int64)
    return chain.fit(kinds, np.repeat(np.arange(len(table)), sizes), index, y, table.column("_fold").to_numpy())


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, p_<category> ..., rejected): probabilities of every whole text; rejected is 1 from ``THRESHOLD`` of the last.

    A null or empty text scores as a text without any word. Rows that share an id have one row each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{name}" for name in chain.names]
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(1))
            for a, b in pieces(texts):
                p = shared.value.score(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *(pa.array(np.ascontiguousarray(x)) for x in p.T)],
                    names=[id_col, *names],
                )

    out = ", ".join([f"`{id_col}` {kind}", *(f"{n} double" for n in names)])
    scored = docs.select(id_col, text_col).mapInArrow(run, out)
    return scored.withColumn("rejected", (F.col(names[-1]) >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that the last category does not reject, all columns; one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    @arrow_udf(DoubleType())
    def last(column: pa.Array) -> pa.Array:
        texts = utf8(column)
        parts = [shared.value.score(texts[a:b])[:, -1] for a, b in pieces(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return docs.filter(last(F.col(text_col)) < THRESHOLD)
