"""Quality by a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins. Boosting goes round the features in turn; each step adds a
shallow tree on one feature, and the trees of a feature add up to one table with a value per bin.
Then pairs of features get tables of their own, by trees with one cut on either axis. A score is the
sum of one entry per table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge.llm.sample import labelled_sample
from pressgauge.llm.scan import Words, grams, pieces, utf8

#: At most this many labelled rows are fitted on.
SAMPLE_ROWS = 20_000
#: Ids with CRC-32 (of the id as text) divisible by this are never fitted on.
HELD_OUT = 5
BINS, PAIR_BINS, PAIRS = 48, 12, 8
ROUNDS, PAIR_ROUNDS, RATE, LEAST_ROWS, RIDGE = 150, 60, 0.1, 10, 1.0
THRESHOLD = 0.3
#: Features of a text, in the order of the columns.
FEATURES = (
    "words", "word_chars", "upper", "digits", "symbols", "stops", "other_ascii", "high_bytes",
    "distinct", "most_common", "repeat_grams", "adjacent_equal", "line_words", "dup_lines",
    "short_words", "long_words", "symbol_words", "lead_upper", "pipes", "bangs",
)


def _set(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table


_UPPER, _DIGIT = _set("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _set("0123456789")
_SYMBOL, _STOP, _OTHER = _set("#*$%&|<>@^~=_+\\/{}[]"), _set(".?!"), _set(",;:'\"()-")
_HIGH, _PIPE, _BANG = np.arange(256) >= 128, _set("|"), _set("!")


def _sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the ranges between ``offsets``."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _groups(of: np.ndarray, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: distinct codes, rows whose code occurs again in the text, rows of the commonest code."""
    if not len(codes):
        return (np.zeros(n),) * 3
    # One sort by text and code: the text's number takes the highest bits.
    high = np.uint64(64 - max(1, int(n).bit_length()))
    key = np.sort((of.astype(np.uint64) << high) | (codes & ((np.uint64(1) << high) - np.uint64(1))))
    o, c = (key >> high).astype(np.int64), key
    first = np.ones(len(c), bool)
    first[1:] = (o[1:] != o[:-1]) | (c[1:] != c[:-1])
    at = np.flatnonzero(first)
    sizes = np.diff(np.append(at, len(c)))
    owner = o[at]
    distinct = np.bincount(owner, minlength=n)
    repeated = np.bincount(owner, np.where(sizes > 1, sizes, 0), minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, owner, sizes)
    return distinct, repeated, most


def features(texts: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text; an empty text has zeros."""
    n = len(texts)
    words = Words(texts)
    of, lengths = words.texts_of(), words.ends - words.starts
    hashes = words.hashes()
    offsets = words.offsets
    size = np.maximum(1, offsets[1:] - offsets[:-1] - 1)
    count = np.diff(words.first)
    some = np.maximum(1, count)
    chars = lambda table: _sum(table[words.data], offsets) / size
    share = lambda mask: np.bincount(of, mask, minlength=n) / some
    distinct, _, most = _groups(of, hashes, n)
    five = grams(hashes, 5)
    inside = of[: len(five)] == of[len(of) - len(five) :] if len(five) else np.zeros(0, bool)
    _, repeated, _ = _groups(of[: len(five)][inside], five[inside], n)
    same = np.zeros(len(of), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    lines, dups = np.zeros(n), np.zeros(n)
    for i, text in enumerate(texts):
        own = [x for x in text.split(b"\n") if x and not x.isspace()]
        lines[i], dups[i] = len(own), len(own) - len(set(own))
    lead = words.data[words.starts] if len(of) else np.zeros(0, np.uint8)
    last = words.data[words.ends - 1] if len(of) else np.zeros(0, np.uint8)
    return np.column_stack(
        (
            np.log1p(count), np.bincount(of, lengths, minlength=n) / some, chars(_UPPER), chars(_DIGIT),
            chars(_SYMBOL), chars(_STOP), chars(_OTHER), chars(_HIGH), distinct / some, most / some,
            repeated / some, share(same), count / np.maximum(1, lines), dups / np.maximum(1, lines),
            share(lengths <= 3), share(lengths >= 12), share(_SYMBOL[last]), share(_UPPER[lead]),
            chars(_PIPE), chars(_BANG),
        )
    )


@dataclass
class Additive:
    """Bin edges, one table per feature, and one per pair of features over coarser bins."""

    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    bias: float = 0.0

    @staticmethod
    def _bins(edges: list[np.ndarray], x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(edges)]

    @staticmethod
    def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
        cuts = np.linspace(0, 1, bins + 1)[1:-1]
        return [np.unique(np.quantile(column, cuts)) if len(x) else np.zeros(0) for column in x.T]

    def logits(self, x: np.ndarray) -> np.ndarray:
        fine, coarse = self._bins(self.edges, x), self._bins(self.coarse, x)
        total = np.full(len(x), self.bias)
        for table, at in zip(self.tables, fine):
            total += table[at]
        for i, j, table in self.pairs:
            total += table[coarse[i], coarse[j]]
        return total

    def fit(self, x: np.ndarray, y: np.ndarray) -> Additive:
        self.edges, self.coarse = self._edges(x, BINS), self._edges(x, PAIR_BINS)
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        mean = (y.sum() + 1) / (len(y) + 2)
        self.bias = float(np.log(mean / (1 - mean)))
        if not 0 < y.sum() < len(y):
            return self
        fine, coarse = self._bins(self.edges, x), self._bins(self.coarse, x)
        f = np.full(len(y), self.bias)
        for _ in range(ROUNDS):
            for table, at in zip(self.tables, fine):
                step = RATE * _tree(at, len(table), *_slopes(f, y))
                table += step
                f += step[at]
        slope, curve = _slopes(f, y)
        sizes = [len(e) + 1 for e in self.coarse]
        every = [(i, j) for i in range(x.shape[1]) for j in range(i)]
        gains = [_cross(coarse[i], coarse[j], sizes[i], sizes[j], slope, curve)[0] for i, j in every]
        best = [every[k] for k in np.argsort(-np.array(gains), kind="stable")[:PAIRS]]
        self.pairs = [(i, j, np.zeros((sizes[i], sizes[j]))) for i, j in best]
        for _ in range(PAIR_ROUNDS):
            for i, j, table in self.pairs:
                step = RATE * _cross(coarse[i], coarse[j], sizes[i], sizes[j], *_slopes(f, y))[1]
                table += step
                f += step[coarse[i], coarse[j]]
        return self


def _slopes(f: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-f))
    return y - p, p * (1 - p)


def _gain(slope: np.ndarray, curve: np.ndarray) -> np.ndarray:
    return slope**2 / (curve + RIDGE)


def _tree(at: np.ndarray, bins: int, slope: np.ndarray, curve: np.ndarray) -> np.ndarray:
    """A value per bin: a tree of two levels on one feature."""
    s, c = np.bincount(at, slope, minlength=bins), np.bincount(at, curve, minlength=bins)
    n = np.bincount(at, minlength=bins)
    out = np.zeros(bins)

    def split(a: int, b: int, depth: int) -> None:
        total_s, total_c, rows = s[a:b].sum(), c[a:b].sum(), n[a:b].sum()
        if depth and b - a > 1:
            left_s, left_c, left_n = np.cumsum(s[a:b])[:-1], np.cumsum(c[a:b])[:-1], np.cumsum(n[a:b])[:-1]
            gain = _gain(left_s, left_c) + _gain(total_s - left_s, total_c - left_c) - _gain(total_s, total_c)
            gain[(left_n < LEAST_ROWS) | (rows - left_n < LEAST_ROWS)] = -1
            cut = int(np.argmax(gain))
            if gain[cut] > 0:
                split(a, a + cut + 1, depth - 1)
                split(a + cut + 1, b, depth - 1)
                return
        out[a:b] = total_s / (total_c + RIDGE)

    split(0, bins, 2)
    return out


def _cross(i: np.ndarray, j: np.ndarray, m: int, n: int, slope: np.ndarray, curve: np.ndarray) -> tuple[float, np.ndarray]:
    """The best pair of cuts, one on either axis: its gain and the table with a value per quadrant."""
    code = i * n + j
    s = np.bincount(code, slope, minlength=m * n).reshape(m, n).cumsum(0).cumsum(1)
    c = np.bincount(code, curve, minlength=m * n).reshape(m, n).cumsum(0).cumsum(1)
    table = np.zeros((m, n))
    if m < 2 or n < 2:
        return 0.0, table
    quarters = []
    for t in (s, c):
        low, rows, cols, total = t[:-1, :-1], t[:-1, -1:], t[-1:, :-1], t[-1, -1]
        quarters.append((low, rows - low, cols - low, total - rows - cols + low))
    gain = sum(_gain(a, b) for a, b in zip(*quarters)) - _gain(s[-1, -1], c[-1, -1])
    a, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    values = [qs[a, b] / (qc[a, b] + RIDGE) for qs, qc in zip(*quarters)]
    table[: a + 1, : b + 1], table[: a + 1, b + 1 :] = values[0], values[1]
    table[a + 1 :, : b + 1], table[a + 1 :, b + 1 :] = values[2], values[3]
    return float(gain[a, b]), table


def _table(docs: DataFrame, keep: list[str], columns) -> DataFrame:
    """``keep`` columns and what ``columns(texts)`` gives: a list of names and a 2-d array."""
    names = columns([])[0]
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(0))
            for a, b in pieces(texts):
                found = columns(texts[a:b])[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(a, b - a) for i in range(1, batch.num_columns)),
                        *(pa.array(np.ascontiguousarray(x), pa.float64()) for x in found.T),
                    ],
                    names=[*keep, *names],
                )

    return docs.select("text", *keep).mapInArrow(run, ", ".join([*kinds, *(f"{n} double" for n in names)]))


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % HELD_OUT == 0


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id") -> Additive:
    """Fit on at most ``rows`` labelled documents that are not held out; null labels are left out."""
    chosen = labelled_sample(docs, labels, rows, ~held_out(id_col) & F.col("quality").isNotNull(), id_col)
    names = [f"f{i}" for i in range(len(FEATURES))]
    table = _table(chosen, ["quality"], lambda texts: (names, features(texts))).toPandas()
    return Additive().fit(table[names].to_numpy(), table["quality"].to_numpy(np.float64))


def score(docs: DataFrame, model: Additive, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): the probability of good quality for every whole text, null and empty texts too.

    Rows that share an id have one row each. Only the text is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        if not texts:
            return ["score"], np.zeros((0, 1))
        return ["score"], 1 / (1 + np.exp(-shared.value.logits(features(texts))))[:, None]

    narrow = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    return _table(narrow, ["_id"], run).withColumnRenamed("_id", id_col)
