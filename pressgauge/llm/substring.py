"""Removal of passages that repeat an earlier document, by suffix automata of reference shards.

A window is 50 consecutive words. Every window has an anchor, the least hash among its runs of 19 words,
so equal windows have equal anchors. Anchors are counted over all documents; one that occurs under
two ids is repeated, and the smallest id with it owns it. The owner's text around its own anchors
is a reference shard: one suffix automaton. Every other document streams its text
around those anchors against that automaton, and the matching statistics tell which of its windows the owner
has. An automaton goes only to tasks that stream documents against it: a copy of all of them to every
executor would have no bound. Anchors of many documents spread over several tasks, each with
a copy of the automaton. Windows that the owner lacks, though it has their anchor, are compared among
the documents that have them by the hash of the whole window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pressgauge.llm.links import settle
from pressgauge.llm.lookup import named_back, numbered_columns
from pressgauge.llm.scan import Words, grams, pieces, sliding, utf8
from pressgauge.session import cut_lineage

WINDOW = 50
#: Rows per task and automaton that an anchor should not exceed by much.
SHARE = 512
#: An automaton takes no more words; windows of the passages beyond are compared by their hashes.
MAX_AUTOMATON_WORDS = 200_000


def _span(window: int) -> int:
    """Runs per window: a power of two of about two thirds of it."""
    return 1 << (max(1, window * 2 // 3).bit_length() - 1)


def _window_anchors(hashes: np.ndarray, window: int) -> np.ndarray:
    """The anchor of each window."""
    span = _span(window)
    if len(hashes) < window:
        return np.zeros(0, np.uint64)
    return sliding(grams(hashes, window - span + 1), span, np.minimum)


class Automaton:
    """Suffix automaton over words."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.last = 0
        self.words = 0

    def add(self, words: list) -> None:
        """Append a passage; no match runs from one passage into the next."""
        nexts, link, length = self.next, self.link, self.length
        last = 0
        self.words += len(words)
        for w in words:
            if w in nexts[last]:
                # The passage repeats one that is known: move on or split the state.
                q = nexts[last][w]
                if length[q] != length[last] + 1:
                    q = self._split(last, w, q)
                last = q
                continue
            new = len(nexts)
            nexts.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and w not in nexts[p]:
                nexts[p][w] = new
                p = link[p]
            if p >= 0:
                q = nexts[p][w]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
            last = new

    def _split(self, p: int, w, q: int) -> int:
        nexts, link, length = self.next, self.link, self.length
        copy = len(nexts)
        nexts.append(nexts[q].copy())
        link.append(link[q])
        length.append(length[p] + 1)
        while p >= 0 and nexts[p].get(w) == q:
            nexts[p][w] = copy
            p = link[p]
        link[q] = copy
        return copy

    def statistics(self, words: list) -> list[int]:
        """For each word, how many words up to it stand together in a passage."""
        nexts, link, length = self.next, self.link, self.length
        state, size, out = 0, 0, []
        for w in words:
            to = nexts[state].get(w)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = nexts[state].get(w)
            if to is None:
                size = 0
            else:
                state = to
                size += 1
            out.append(size)
        return out


def _anchors(docs: DataFrame, window: int, kind: str) -> DataFrame:
    """(id, th, anchor) for each change of anchor along every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(2))
            for a, b in pieces(texts):
                words = Words(texts[a:b])
                found = _window_anchors(words.hashes(), window)
                if not len(found):
                    continue
                of = np.repeat(np.arange(a, b), np.diff(words.first))
                begin, end = of[: len(found)], of[window - 1 :]
                new = np.ones(len(found), bool)
                new[1:] = (found[1:] != found[:-1]) | (begin[1:] != begin[:-1]) | (end[:-1] != begin[:-1])
                at = np.flatnonzero(new & (begin == end))
                rows = pa.array(begin[at])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(found[at].view(np.int64))],
                    names=["id", "th", "anchor"],
                )

    return docs.mapInArrow(run, f"id {kind}, th bigint, anchor bigint")


def _segments(live: DataFrame, window: int, kind: str) -> DataFrame:
    """Runs of windows with one owner, as text: reference rows (kind 0) and streamed rows (kind 1)."""
    names = ["owner", "k", "salt", "kind", "id", "th", "start", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            columns = [batch.column(i) for i in range(len(batch.schema))]
            for i, text in enumerate(utf8(columns[2])):
                key, th = columns[0][i].as_py(), columns[1][i].as_py()
                marks = columns[3][i].values.flatten()
                order = np.argsort(marks[0].to_numpy(zero_copy_only=False))
                known = marks[0].to_numpy(zero_copy_only=False)[order]
                owners, counts = marks[1].take(pa.array(order)), marks[2].to_numpy()[order]
                words = Words([text])
                found = _window_anchors(words.hashes(), window).view(np.int64)
                at = np.searchsorted(known, found)
                at[at == len(known)] = 0
                owner_no = np.unique([str(o) for o in owners.to_pylist()], return_inverse=True)[1]
                copies = 1 << np.ceil(np.log2(np.maximum(1, counts / SHARE))).astype(np.int64)
                group = (owner_no * 64 + np.log2(copies).astype(np.int64))[at]
                group[known[at] != found] = -1
                cuts = np.flatnonzero(np.diff(group)) + 1
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(group)]):
                    if a == b or group[a] < 0:
                        continue
                    owner, k = owners[int(at[a])].as_py(), int(copies[at[a]])
                    part = text[words.starts[a] : words.ends[b + window - 2]]
                    mine = owner == key
                    for salt in range(k) if mine else (th % k,):
                        rows.append((owner, k, salt, int(not mine), key, th, a, part))
                        size += len(part)
                if size > 8 << 20:
                    yield _batch(rows, names, schema)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, names, schema)

    out = f"owner {kind}, k int, salt int, kind int, id {kind}, th bigint, start bigint, text binary"
    schema = _arrow(live.sparkSession, out)
    return live.mapInArrow(run, out)


def _arrow(spark, ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _batch(rows: list[tuple], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, schema.field(n).type) for n, c in zip(names, columns)], schema=schema
    )


def _matches(segments: DataFrame, window: int, kind: str) -> DataFrame:
    """(id, th, start, end, hash): word spans that the owner has, and with a hash each window it lacks."""
    names = ["id", "th", "start", "end", "hash"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, automaton = None, Automaton()
        for batch in batches:
            rows: list[tuple] = []
            cols = [batch.column(i).to_pylist() for i in range(8)]
            for owner, k, salt, role, key, th, start, text in zip(*cols):
                if (owner, k, salt) != shard:
                    shard, automaton = (owner, k, salt), Automaton()
                words = text.split()
                if role == 0 and automaton.words + len(words) <= MAX_AUTOMATON_WORDS:
                    automaton.add(words)
                    continue
                windows = len(words) - window + 1
                if role:
                    found = np.array(automaton.statistics(words)[window - 1 :]) >= window
                else:  # what the automaton has no room for is compared by hash
                    found = np.zeros(windows, bool)
                edges = np.diff(np.concatenate(([0], found.astype(np.int8), [0])))
                for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
                    rows.append((key, th, start + a, start + b + window - 1, None))
                if not found.all():
                    hashes = grams(Words([text]).hashes(), window).view(np.int64)
                    for a in np.flatnonzero(~found).tolist():
                        rows.append((key, th, start + a, start + a + window, int(hashes[a])))
            if rows:
                yield _batch(rows, names, schema)

    out = f"id {kind}, th bigint, start bigint, end bigint, hash bigint"
    schema = _arrow(segments.sparkSession, out)
    return segments.mapInArrow(run, out)


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, th, spans): word spans [start, end) of each text to remove; ``th`` is the text's XXH64.

    A word is in a span if a window over it also starts in a document with a smaller id. Texts of
    fewer words than a window, null texts and rows without an id have none and are in nobody's way. Rows that share an
    id do not count against one another.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text")
    ).filter(F.col("id").isNotNull() & (F.octet_length("text") >= 2 * window - 1))
    anchors = cut_lineage(_anchors(narrow, window, kind), "anchors")
    owned = settle(
        anchors.groupBy("anchor")
        .agg(F.min("id").alias("owner"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
        .filter("owner < last")
        .select("anchor", "owner", "n"),
        "owners",
    )
    marks = (
        anchors.join(owned, "anchor")
        .groupBy("id", "th")
        .agg(F.collect_set(F.struct("anchor", "owner", "n")).alias("marks"))
    )
    segments = _segments(narrow.join(marks, ["id", "th"]), window, kind)
    dealt = segments.repartition("owner", "k", "salt").sortWithinPartitions(
        "owner", "k", "salt", "kind", "id", "th", "start"
    )
    found = settle(_matches(dealt, window, kind), "matches")
    rest = found.filter("hash IS NOT NULL")
    first = rest.groupBy("hash").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    also = rest.join(first.filter("first < last"), "hash").filter("id > first")
    spans = found.filter("hash IS NULL").select("id", "th", "start", "end").unionByName(
        also.select("id", "th", "start", "end")
    )
    return spans.groupBy("id", "th").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


_CUT = StructType(
    [StructField("text", StringType()), StructField("n_words", LongType()), StructField("n_removed", LongType())]
)


@arrow_udf(_CUT)
def _without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    kept, totals, removed = [], [], []
    for raw, cuts in zip(texts.cast(pa.binary()).to_pylist(), spans.to_pylist()):
        if not cuts:
            kept.append(raw)
            totals.append(len(raw.split()) if raw else 0)
            removed.append(0)
            continue
        words = Words([raw])
        n = len(words.starts)
        marks = np.zeros(n + 1, np.int64)
        for cut in cuts:
            marks[cut["start"]] += 1
            marks[cut["end"]] -= 1
        gone = np.cumsum(marks)[:n] > 0
        edges = np.diff(np.concatenate(([0], (~gone).astype(np.int8), [0])))
        begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        parts = [raw[words.starts[a] : words.ends[b - 1]] for a, b in zip(begins, ends)]
        kept.append(b" ".join(parts))
        totals.append(n)
        removed.append(int(gone.sum()))
    return pa.StructArray.from_arrays(
        [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(totals, pa.int64()), pa.array(removed, pa.int64())],
        names=["text", "n_words", "n_removed"],
    )


def remove_repeated(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with repeated passages cut out of the text, and ``n_words`` and ``n_removed`` as columns.

    White space between words that stay is kept as it is; one space joins the parts on either side
    of a cut. A text without a cut is unchanged, null included. Columns of ``docs`` called ``n_words`` or ``n_removed`` give
    way to the counts; :func:`cut_texts` keeps them.
    """
    rows, names = numbered_columns(docs)
    key, text = names[id_col], names[text_col]
    spans = repeated_spans(rows, window, key, text).select(
        F.col("id").alias("_id"), F.col("th").alias("_th"), F.col("spans").alias("_spans")
    )
    same = (F.col(key) == F.col("_id")) & (F.xxhash64(text) == F.col("_th"))
    cut = rows.join(spans, same, "left").withColumn("_cut", _without(F.col(text), F.col("_spans")))
    kept = [F.col("_cut.text" if c == text_col else new).alias(c) for c, new in names.items() if c.lower() not in ("n_words", "n_removed")]
    return cut.select(*kept, F.col("_cut.n_words").alias("n_words"), F.col("_cut.n_removed").alias("n_removed"))


def cut_texts(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with repeated passages cut out of the text and no column more.

    ``length_col``, if ``docs`` has it, gets the number of characters left in each text that was cut.
    """
    rows, names = numbered_columns(docs)
    cut = remove_repeated(rows, window, names[id_col], names[text_col])
    if length_col in names:
        length = names[length_col]
        left = F.length(names[text_col]).cast(rows.schema[length].dataType)
        cut = cut.withColumn(length, F.when(F.col("n_removed") > 0, left).otherwise(F.col(length)))
    return named_back(cut, names)
