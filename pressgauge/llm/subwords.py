"""SentencePiece encoding and decoding by a relational lattice of pieces.

A text is cut into units: a run of word marks and what follows up to the next mark. No piece spans two units, so
a unit is encoded alone. The frequent units of the corpus, counted by Spark, get their lattice as
a table: their substrings, no longer than the longest piece, are joined with the piece table, the edges are
grouped by unit, and a higher-order aggregate folds the edges to the ids. A unigram model
folds the best path (Viterbi). In a BPE model the best path is not the encoding, as pieces are
ranked by the order of their merges: there the fold joins, step by step, the neighbours whose edge has the
best score. The folded units are broadcast, at most ``FREQUENT`` of them; other units are folded in the
workers by the same rule, once per worker.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType, StringType

from pressgauge.session import cut_lineage

MARK = "▁"
#: Marks with what follows them; a line break is no part of any piece.
UNIT = f"{MARK}*[^{MARK}\\n]+|{MARK}+|\\n"
#: Units of the corpus that Spark folds, at most, and their longest.
FREQUENT = 1 << 15
LONGEST_FREQUENT = 32
#: A worker keeps two generations of so many units that it has folded; longer units are not kept.
CACHE_UNITS = 200_000
LONGEST_CACHED = 48
#: Rows that round_trips() hands on at a time.
BATCH_ROWS = 512
UNKNOWN = -100.0
_NONE = float("-inf")
_units = re.compile(UNIT)
_workers: dict[str, "_Cache"] = {}


class _Cache:
    """Folded units of one worker. When the younger generation is full it becomes the older one, so units in use stay."""

    def __init__(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, unit: str, pieces: Pieces) -> bytes:
        ids = self.young.get(unit)
        if ids is None:
            ids = self.old.get(unit)
            if ids is None:
                ids = pieces.merge(unit)
            if len(unit) <= LONGEST_CACHED:
                if len(self.young) >= CACHE_UNITS:
                    self.old, self.young = self.young, {}
                self.young[unit] = ids
        return ids


@dataclass
class Pieces:
    """The pieces of a model file: text, id and score; the first of the 256 byte pieces."""

    rows: list[tuple[str, int, float]]
    first_byte: int
    scores: dict[str, float]
    codes: dict[str, bytes]

    @staticmethod
    def load(path: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        plain = [
            i for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        return Pieces.of([(model.id_to_piece(i), i, model.get_score(i)) for i in plain], model.piece_to_id("<0x00>"))

    @staticmethod
    def of(rows: list[tuple[str, int, float]], first_byte: int) -> Pieces:
        codes = {piece: np.array([i], np.int32).tobytes() for piece, i, _ in rows}
        return Pieces(rows, first_byte, {piece: score for piece, _, score in rows}, codes)

    def texts(self) -> np.ndarray:
        """What each id stands for, marks as spaces; an id without a piece stands for nothing."""
        byte = {self.first_byte + b: bytes([b]) for b in range(256)}
        known = byte | {i: piece.replace(MARK, " ").encode() for piece, i, _ in self.rows}
        return np.array([known.get(i, b"") for i in range(max(known) + 1)], dtype=object)

    def merge(self, unit: str) -> bytes:
        """Ids of one unit as 32-bit integers, by joining the best neighbours; the leftmost of equals."""
        score, code, n = self.scores.get, self.codes.get, len(unit)
        if n > 40:
            cuts = self._merge_long(unit)
        else:
            cuts = list(range(n + 1))
            # gains[i]: score of the piece that joins what begins at cuts[i] with its right neighbour
            gains = [score(unit[i : i + 2], _NONE) for i in range(n - 1)]
            while gains:
                best = max(gains)
                if best == _NONE:
                    break
                i = gains.index(best)
                del cuts[i + 1], gains[i]
                if i:
                    gains[i - 1] = score(unit[cuts[i - 1] : cuts[i + 1]], _NONE)
                if i < len(gains):
                    gains[i] = score(unit[cuts[i] : cuts[i + 2]], _NONE)
        out = []
        for a, b in zip(cuts, cuts[1:]):
            known = code(unit[a:b])
            if known is None:
                known = np.array([self.first_byte + x for x in unit[a:b].encode()], np.int32).tobytes()
            out.append(known)
        return b"".join(out)

    def _merge_long(self, unit: str) -> list[int]:
        """The same cuts with a heap: the time grows with n log n."""
        n = len(unit)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, int]] = []

        def offer(a: int) -> None:
            b = end[a]
            if b < n and (found := self.scores.get(unit[a : end[b]])) is not None:
                heapq.heappush(heap, (-found, a, end[b]))

        for i in range(n):
            offer(i)
        alive = [True] * n
        while heap:
            _, a, to = heapq.heappop(heap)
            if not alive[a] or end[a] >= n or not alive[end[a]] or end[end[a]] != to:
                continue
            alive[end[a]] = False
            end[a] = to
            if to < n:
                before[to] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return [i for i in range(n) if alive[i]] + [n]


def _normal(text: Column) -> Column:
    """Spaces as marks, with one before the text; null and empty texts are empty."""
    marked = F.concat(F.lit(MARK), F.replace(text, F.lit(" "), F.lit(MARK)))
    return F.when(F.length(text) > 0, marked).otherwise("")


def frequent_units(docs: DataFrame, text_col: str = "text", most: int = FREQUENT) -> DataFrame:
    """(unit): the most frequent units of all texts, whole frequencies at a time, ``most`` at most.

    The least frequency comes from a table of frequencies, so no task sees all units.
    """
    units = docs.select(F.explode(F.regexp_extract_all(_normal(F.col(text_col)), F.lit(UNIT), F.lit(0))).alias("unit"))
    counted = cut_lineage(
        units.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).filter(F.length("unit") <= LONGEST_FREQUENT), "units"
    )
    steps = counted.groupBy("n").agg(F.count(F.lit(1)).alias("units")).orderBy(F.desc("n")).limit(most).collect()
    total, least = 0, None
    for step in steps:
        total += step["units"]
        if total > most:
            break
        least = step["n"]
    return counted.filter(F.col("n") >= F.lit(least).cast("bigint")).select("unit")


def lattice(units: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, edges): every piece inside each unit as (start, end, id, score); units without any have an empty list.

    The piece table is as large as the model's vocabulary and is broadcast.
    """
    spark = units.sparkSession
    longest = max((len(p) for p, _, _ in pieces.rows), default=1)
    table = spark.createDataFrame(pieces.rows, "piece string, id int, score double")
    starts = units.select("unit", F.explode(F.sequence(F.lit(0), F.length("unit") - 1)).alias("start"))
    ends = starts.select(
        "unit", "start",
        F.explode(F.sequence(F.col("start") + 1, F.least(F.length("unit"), F.col("start") + longest))).alias("end"),
    )
    parts = ends.withColumn("piece", F.substring(F.col("unit"), F.col("start") + 1, F.col("end") - F.col("start")))
    edges = parts.join(F.broadcast(table), "piece", "left")
    edge = F.when(F.col("id").isNotNull(), F.struct("start", "end", "id", "score"))
    return edges.groupBy("unit").agg(F.collect_list(edge).alias("edges"))


def _byte_ids(char: Column, first: int) -> Column:
    digits = F.hex(F.encode(char, "utf-8"))
    return F.transform(
        F.sequence(F.lit(1), F.octet_length(char)),
        lambda i: (F.conv(F.substring(digits, 2 * i - 1, F.lit(2)), 16, 10).cast("int") + first),
    )


def _ids(unit: Column, cuts: Column, ids: Column, first: int) -> Column:
    """Ids between consecutive cuts; a character without a piece gives its bytes."""

    def one(i: Column) -> Column:
        a, b = F.get(cuts, i), F.get(cuts, i + 1)
        known = F.try_element_at(ids, a * 1000 + b)
        return F.when(known.isNotNull(), F.array(known)).otherwise(
            _byte_ids(F.substring(unit, a + 1, b - a), first)
        )

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(cuts) - 2), one))


def fold_merges(edges: DataFrame, first_byte: int) -> DataFrame:
    """(unit, ids): join the neighbours with the best edge until none is left."""
    key = lambda e: e["start"] * 1000 + e["end"]
    maps = edges.select(
        "unit",
        F.map_from_entries(F.transform("edges", lambda e: F.struct(key(e), e["score"]))).alias("scores"),
        F.map_from_entries(F.transform("edges", lambda e: F.struct(key(e), e["id"]))).alias("ids"),
    )

    def step(cuts: Column, _: Column) -> Column:
        def pair(i: Column) -> Column:
            score = F.try_element_at("scores", F.get(cuts, i) * 1000 + F.get(cuts, i + 2))
            return F.when(score.isNotNull(), F.struct(score.alias("score"), (-i).alias("at")))

        best = F.array_max(F.filter(F.transform(F.sequence(F.lit(0), F.size(cuts) - 3), pair), lambda p: p.isNotNull()))
        drop = F.coalesce(1 - best["at"], F.lit(-1))
        return F.when(F.size(cuts) < 3, cuts).otherwise(F.filter(cuts, lambda c, j: j != drop))

    n = F.length("unit")
    cuts = F.aggregate(F.sequence(F.lit(1), n), F.sequence(F.lit(0), n), step)
    folded = maps.select("unit", "ids", cuts.alias("cuts"))
    return folded.select("unit", _ids(F.col("unit"), F.col("cuts"), F.col("ids"), first_byte).alias("ids"))


def fold_viterbi(edges: DataFrame, first_byte: int) -> DataFrame:
    """(unit, ids): the path with the largest sum of scores; a character without a piece costs ``UNKNOWN``.

    Of equal paths the one whose last piece begins later wins.
    """
    n = F.length("unit")
    begin = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(-1).alias("start")))

    def forward(best: Column, x: Column) -> Column:
        into = F.filter("edges", lambda e: e["end"] == x)
        paths = F.transform(into, lambda e: F.struct((F.get(best, e["start"])["score"] + e["score"]).alias("score"), e["start"].alias("start")))
        single = F.array(F.struct((F.get(best, x - 1)["score"] + UNKNOWN).alias("score"), (x - 1).alias("start")))
        return F.array_append(best, F.array_max(F.when(F.size(paths) > 0, paths).otherwise(single)))

    best = F.aggregate(F.sequence(F.lit(1), n), begin, forward)

    def back(cuts: Column, _: Column) -> Column:
        at = F.get(cuts, F.lit(0))
        return F.when(at == 0, cuts).otherwise(F.array_prepend(cuts, F.get(F.col("best"), at)["start"]))

    ids = F.map_from_entries(F.transform("edges", lambda e: F.struct(e["start"] * 1000 + e["end"], e["id"])))
    walked = edges.select("unit", ids.alias("ids"), best.alias("best"))
    cuts = walked.select("unit", "ids", F.aggregate(F.sequence(F.lit(1), n), F.array(n), back).alias("cuts"))
    return cuts.select("unit", _ids(F.col("unit"), F.col("cuts"), F.col("ids"), first_byte).alias("ids"))


class Codec:
    """Encoder and decoder of one BPE model, with the frequent units of one corpus."""

    def __init__(self, spark: SparkSession, path: str, frequent: dict[str, bytes]):
        self.name = path
        pieces = Pieces.load(path)
        self._shared = spark.sparkContext.broadcast((pieces, frequent, pieces.texts()))

    @staticmethod
    def fit(docs: DataFrame, path: str, text_col: str = "text", most: int = FREQUENT) -> Codec:
        """Fold the frequent units of ``docs``; any other text can be encoded as well."""
        pieces = Pieces.load(path)
        units = frequent_units(docs, text_col, most)
        # A fixed number of parts: the table is small, the folding is not.
        dealt = units.repartition(4 * docs.sparkSession.sparkContext.defaultParallelism, "unit")
        folded = fold_merges(lattice(dealt, pieces), pieces.first_byte).toArrow()
        lists = folded.column("ids").combine_chunks() if len(folded) else []
        ids = {u: np.array(x.values.to_numpy(), np.int32).tobytes() for u, x in zip(folded.column("unit").to_pylist(), lists)}
        return Codec(docs.sparkSession, path, ids)

    def encode(self, text: Column) -> Column:
        """Ids of every whole text as the model's library gives them, without begin and end; null and empty texts have none."""
        shared, name = self._shared, self.name

        @arrow_udf(ArrayType(IntegerType()))
        def encoded(texts: pa.Array) -> pa.Array:
            from pressgauge.llm import subwords

            cache = subwords._workers.setdefault(name, subwords._Cache())
            pieces, frequent, _ = shared.value
            out, sizes = [], [0]
            for text in texts:
                ids = subwords._encoded(text.as_py() or "", pieces, frequent, cache)
                out.append(ids)
                sizes.append(sizes[-1] + len(ids) // 4)
            values = pa.array(np.frombuffer(b"".join(out), np.int32))
            return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), values)

        # Else the optimizer encodes once more for each expression over the ids.
        return encoded.asNondeterministic()(text)

    def round_trips(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, ids, round_trip): ids of every whole text, and whether decoding gives the text back; one pass in small batches."""
        shared, name = self._shared, self.name
        kind = docs.schema[id_col].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pressgauge.llm import subwords

            cache = subwords._workers.setdefault(name, subwords._Cache())
            pieces, frequent, stands = shared.value
            for whole in batches:
                for at in range(0, len(whole), BATCH_ROWS):
                    batch = whole.slice(at, BATCH_ROWS)
                    out, sizes, same = [], [0], []
                    for text in batch.column(1):
                        text = text.as_py() or ""
                        out.append(subwords._encoded(text, pieces, frequent, cache))
                        ids = np.frombuffer(out[-1], np.int32)
                        sizes.append(sizes[-1] + len(ids))
                        same.append(subwords._decoded(ids, stands) == text.replace(MARK, " "))
                    values = pa.array(np.frombuffer(b"".join(out), np.int32))
                    lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), values)
                    yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(same)], names=[id_col, "ids", "round_trip"])

        return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, round_trip boolean")

    def decode(self, ids: Column) -> Column:
        """The text of each list of ids; a mark character in the encoded text comes back as a space, all else as it was. Null gives the empty text."""
        shared = self._shared

        @arrow_udf(StringType())
        def decoded(lists: pa.Array) -> pa.Array:
            stands = shared.value[2]
            values = lists.flatten().to_numpy()
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy())
            out = [_decoded(part, stands) for part in np.split(values, ends[:-1])]
            return pa.array(out[: len(lists)], pa.string())

        return decoded(ids)


def _encoded(text: str, pieces: Pieces, frequent: dict[str, bytes], cache: _Cache) -> bytes:
    if not text:
        return b""
    units = _units.findall(MARK + text.replace(" ", MARK))
    found = list(map(frequent.get, units))
    if None in found:
        found = [cache.ids(unit, pieces) if ids is None else ids for unit, ids in zip(units, found)]
    return b"".join(found)


def _decoded(ids: np.ndarray, stands: np.ndarray) -> str:
    return b"".join(stands[ids].tolist())[1:].decode("utf-8", "replace")
