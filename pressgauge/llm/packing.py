"""Best-fit packing of token pieces into sequences by a configuration linear program.

A configuration is a multiset of lengths that fit one sequence. The linear program asks for the least
number of configurations that cover the length histogram. It is solved by multiplicative weights: every
length has a price, a knapsack over all capacities finds the configurations worth most at these prices,
and the price of a length falls with what has been covered of it. The fractional numbers are rounded down
where they would take more pieces than there are, what is left goes through the program again, and the
last rest is packed best fit, all copies of a length at once. The histogram has at most ``limit`` rows
whatever the corpus, so the program is the same work at every size; pieces are only numbered and looked up.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressgauge.llm.bpe_ids import Encoder
from pressgauge.llm.scan import utf8
from pressgauge.session import cut_lineage

LIMIT = 2048
END_ID = 0
#: Rounds of prices in one solution of the program, and how strongly a covered length falls in price.
ROUNDS = 24
STEP = 0.35
#: Rounds after which prices are near enough to count the configurations they ask for.
WARM = 8
#: The program is solved again for what rounding left, at most so often.
PASSES = 4
_workers: dict[str, Encoder] = {}


def pieces(
    docs: DataFrame, path: str, limit: int = LIMIT, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, rank): the pieces of every whole text.

    A text is its ids and ``end_id``; longer ones than ``limit`` are cut into pieces of that length, the
    last of which may be shorter. A null or empty text is ``end_id`` alone. ``rank`` counts the pieces of
    equal length that task ``part`` wrote before this one.
    """
    end = np.array([end_id], "<u4").tobytes()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pressgauge.llm import packing

        if path not in packing._workers:
            packing._workers[path] = Encoder(path)
        encoder, part = packing._workers[path], TaskContext.get().partitionId()
        written = np.zeros(limit + 1, np.int64)
        for batch in batches:
            row, piece, start, length, crc, rank = [], [], [], [], [], []
            for i, ids in enumerate(encoder.encode(utf8(batch.column(1)))):
                coded = ids.tobytes() + end
                for k, at in enumerate(range(0, len(coded), 4 * limit)):
                    one = coded[at : at + 4 * limit]
                    n = len(one) // 4
                    row.append(i)
                    piece.append(k)
                    start.append(k * limit)
                    length.append(n)
                    crc.append(zlib.crc32(one))
                    rank.append(written[n])
                    written[n] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([part] * len(row), pa.int32()),
                    pa.array(rank, pa.int64()),
                ],
                names=[id_col, "piece", "start", "length", "ids_crc32", "part", "rank"],
            )

    out = f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint"
    return docs.select(id_col, text_col).mapInArrow(run, out)


Pattern = tuple[tuple[int, int], ...]  # (length, copies), longest first


def _knapsack(lengths: np.ndarray, prices: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For every capacity the greatest worth of lengths that fit it, and the length to take first (0: leave a place empty)."""
    worth, take = np.zeros(limit + 1), np.zeros(limit + 1, np.int64)
    for room in range(1, limit + 1):
        n = int(np.searchsorted(lengths, room, "right"))
        worth[room] = worth[room - 1]
        if n:
            with_one = worth[room - lengths[:n]] + prices[:n]
            best = n - 1 - int(np.argmax(with_one[::-1]))  # of equal worth the longest
            if with_one[best] >= worth[room]:
                worth[room], take[room] = with_one[best], lengths[best]
    return worth, take


def _pattern(first: int, take: np.ndarray, limit: int) -> Pattern:
    """The configuration of a length and the best use of the room beside it."""
    copies, room = {first: 1}, limit - first
    while room > 0:
        one = int(take[room])
        if one:
            copies[one] = copies.get(one, 0) + 1
        room -= one or 1
    return tuple(sorted(copies.items(), reverse=True))


def solve(counts: np.ndarray, limit: int, rounds: int = ROUNDS) -> dict[Pattern, float]:
    """Configurations with fractional numbers that cover no length more than once over.

    In every round each length still in demand gets the configuration that is worth most with it, as far as the round's
    unit of every length in it lasts. The sum over the rounds after ``WARM`` is divided by the greatest cover of a length.
    """
    lengths = np.flatnonzero(counts)
    demand = counts[lengths].astype(float)
    prices, covered, total = lengths / limit, np.zeros(len(lengths)), {}
    place = {int(n): i for i, n in enumerate(lengths)}
    for turn in range(rounds):
        _, take = _knapsack(lengths, prices, limit)
        left = np.ones(len(lengths))
        for first in lengths[::-1].tolist():
            if left[place[first]] <= 0:
                continue
            pattern = _pattern(first, take, limit)
            at = [place[n] for n, _ in pattern]
            times = min(left[i] * demand[i] / k for i, (_, k) in zip(at, pattern))
            if times > 0:
                for i, (_, k) in zip(at, pattern):
                    left[i] = max(0.0, left[i] - k * times / demand[i])
                if turn >= WARM:
                    total[pattern] = total.get(pattern, 0.0) + times
        covered += (1 - left) * (turn >= WARM)
        prices = prices * np.exp(-STEP * (1 - left))
        prices = prices / max(prices.max(), 1e-300)
    most = covered.max(initial=0.0) or 1.0
    return {pattern: times / most for pattern, times in total.items()}


def _round(solution: dict[Pattern, float], counts: np.ndarray, limit: int) -> list[tuple[Pattern, int]]:
    """Whole numbers for the configurations, taken out of ``counts``; full ones are rounded up while their pieces last."""
    taken = []

    def order(item):
        return (-item[1], item[0])

    for pattern, times in sorted(solution.items(), key=order):
        full = sum(n * k for n, k in pattern) == limit
        whole = int(np.ceil(times)) if full else int(times)
        whole = min([whole, *(int(counts[n]) // k for n, k in pattern)])
        if whole > 0:
            for n, k in pattern:
                counts[n] -= whole * k
            taken.append((pattern, whole))
    return taken


def best_fit(counts: np.ndarray, limit: int) -> list[tuple[Pattern, int]]:
    """Best fit, longest first; sequences with equal content are one entry however many they are."""
    rooms: list[int] = []
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(room: int, content: tuple[int, ...], times: int) -> None:
        if room not in bins:
            bins[room] = []
            insort(rooms, room)
        bins[room].append((content, times))

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = limit // length
                if left >= each:
                    put(limit - each * length, (length,) * each, left // each)
                    left %= each
                else:
                    put(limit - left * length, (length,) * left, 1)
                    left = 0
                continue
            room = rooms[at]
            content, times = bins[room].pop()
            if not bins[room]:
                del bins[room], rooms[at]
            each = min(room // length, max(1, left // times))
            used = min(times, left // each)
            put(room - each * length, content + (length,) * each, used)
            if used < times:
                put(room, content, times - used)
            left -= used * each
    out = []
    for entries in bins.values():
        for content, times in entries:
            found = sorted(set(content), reverse=True)
            out.append((tuple((n, content.count(n)) for n in found), times))
    return out


def configurations(counts: np.ndarray, limit: int = LIMIT, passes: int = PASSES) -> list[tuple[Pattern, int]]:
    """Configurations and how often each is used, together exactly ``counts`` (index: length).

    After every pass the rest is also packed best fit; the pass after which that gives the fewest sequences counts.
    No pass follows one that needs no more sequences than all pieces laid end to end.
    """
    rest = counts.astype(np.int64).copy()
    taken = [(((limit, 1),), int(rest[limit]))] if rest[limit] else []
    rest[limit] = 0
    least = -(-int((counts * np.arange(limit + 1)).sum()) // limit)
    best: list | None = None
    for _ in range(passes):
        before = int(rest.sum())
        if before:
            taken = taken + _round(solve(rest, limit), rest, limit)
        whole = taken + best_fit(rest, limit)
        if best is None or sum(t for _, t in whole) < sum(t for _, t in best):
            best = whole
        if int(rest.sum()) in (0, before) or sum(t for _, t in best) == least:
            break
    return best or []


def _slots(packed: list[tuple[Pattern, int]], limit: int) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: where each configuration's slots begin among all of that length, its first sequence, copies, offset."""
    by: dict[int, list[tuple[int, int, int, int]]] = {}
    used = np.zeros(limit + 1, np.int64)
    sequence = 0
    for pattern, times in packed:
        offset = 0
        for n, k in pattern:
            by.setdefault(n, []).append((int(used[n]), sequence, k, offset))
            used[n] += times * k
            offset += n * k
        sequence += times
    return {n: tuple(np.array(x, np.int64) for x in zip(*rows)) for n, rows in by.items()}


def pack(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` in place of ``part`` and ``rank``.

    ``pieces`` has to be a written table, for tasks number its rows. The length histogram is all that the driver sees;
    the slots of a length are broadcast, and their number depends on ``limit`` alone. Pieces meet the number
    of equal ones before their task by (part, length), of which no task wrote more than its share.
    """
    counted = cut_lineage(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")).coalesce(32), "lengths")
    histogram = np.zeros(limit + 1, np.int64)
    for row in counted.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    shared = pieces.sparkSession.sparkContext.broadcast(_slots(configurations(histogram, limit), limit))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = pieces.join(before, ["part", "length"]).withColumn("nth", F.col("before") + F.col("rank"))
    kept = [c for c in pieces.columns if c not in ("part", "rank")]
    schema = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, nth = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "nth"))
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order], prepend=-1))
            for a, b in zip(edges, [*edges[1:], len(order)]):
                rows = order[a:b]
                begin, base, copies, at = shared.value[int(length[rows[0]])]
                which = np.searchsorted(begin, nth[rows], "right") - 1
                turn, copy = np.divmod(nth[rows] - begin[which], copies[which])
                sequence[rows] = base[which] + turn
                offset[rows] = at[which] + copy * length[rows]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    return numbered.select(*kept, "nth").mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(
    docs: DataFrame, path: str, limit: int = LIMIT, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every whole text.

    Sequences hold at most ``limit`` ids, without gaps. A null or empty text is one piece of length 1. Rows that share
    an id, a null one included, have their own pieces each; repeated rows are packed as often as they come. Other
    columns of ``docs`` are not read. An empty table gives an empty table. Which of several pieces of
    equal length comes to which sequence depends on how the table is split over tasks.
    """
    return pack(cut_lineage(pieces(docs, path, limit, end_id, id_col, text_col), "pieces"), limit)
