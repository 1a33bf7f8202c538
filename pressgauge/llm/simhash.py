"""Near duplicates by SimHash, with pigeonring filtering of candidates.

A fingerprint is a ring of five segments. When two fingerprints differ in at most four bits, some
segment begins a chain whose first ``l`` segments differ in at most ``4 l / 5`` bits in total, for
every ``l`` up to five: 0, 1, 2, 3 and 4 bits. The first two lengths are an equi-join: equal bits in
the first segment, at most one other bit in the second. The join's condition checks the longer
chains one after the other, and the last of them is the full Hamming distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressgauge.llm.links import components, settle
from pressgauge.llm.lookup import named_back, numbered_columns
from pressgauge.llm.scan import utf8
from pressgauge.operators.skew import counted_join, skewed_join
from pressgauge.session import cut_lineage

SHINGLE_WORDS = 4
HASH_SEED = 42
MAX_BITS = 4
SEGMENTS = 5
WIDTH = 13  # bits of a segment; the last one has the 12 that are left
_COUNT_AT_ONCE = 1 << 16
#: More keys than this are not broadcast: each takes some 100 bytes in every executor.
MAX_BROADCAST_KEYS = 2_000_000


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """SimHash of one text, unsigned; zero without a word."""
    parts = text.lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends[words - 1 :].tolist() or [len(line)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[a:b], HASH_SEED) for a, b in zip(starts, ends)), np.uint64, len(ends)
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _COUNT_AT_ONCE):
        rows = hashes[at : at + _COUNT_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of every whole text as a signed long. Null and empty texts give zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter(map(fingerprint, utf8(batch.column(1))), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64))], names=["id", "fp"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, fp bigint"
    )


def _turned(fp: Column, i: int) -> Column:
    """The ring turned so that segment ``i`` has the lowest bits."""
    by = WIDTH * i
    return fp if not by else F.shiftrightunsigned(fp, by).bitwiseOR(F.shiftleft(fp, 64 - by))


def _rows(prints: DataFrame) -> DataFrame:
    """(fp, key, ring): five rows a fingerprint; the key has the place and the first two segments."""
    wide = F.lit((1 << 2 * WIDTH) - 1)

    def one(i: int) -> Column:
        # The short segment makes its chain's first two segments one bit shorter.
        bits = wide if i not in (SEGMENTS - 2, SEGMENTS - 1) else F.lit((1 << 2 * WIDTH - 1) - 1)
        ring = _turned(F.col("fp"), i)
        return F.struct(
            ring.bitwiseAND(bits).bitwiseOR(F.lit(i << 2 * WIDTH)).alias("key"), ring.alias("ring")
        )

    rows = F.explode(F.array(*[one(i) for i in range(SEGMENTS)]))
    return prints.select("fp", rows.alias("r")).select("fp", "r.key", "r.ring")


def near_pairs(prints: DataFrame) -> DataFrame:
    """(a, b): pairs of different values of ``fp`` with at most four other bits; a pair may come twice.

    The key has about 26 of 64 bits, so equal keys of unrelated texts are rare, and the whole
    chain is part of the join: only true links leave it. A side emits its key and the keys with
    one 0 of the second segment set, so of two fingerprints one reaches the other.
    """
    index = _rows(prints)
    place = F.shiftright("key", 2 * WIDTH)
    # Where the second segment begins: after a first segment of 13 bits, or of 12 at the last place.
    low = F.when(place == SEGMENTS - 1, WIDTH - 1).otherwise(WIDTH)
    high = F.when(place >= SEGMENTS - 2, 2 * WIDTH - 1).otherwise(2 * WIDTH)
    bits = F.sequence(low, high - 1)
    one = F.lit(1).cast("bigint")
    flips = F.filter(
        F.transform(bits, lambda b: F.call_function("shiftleft", one, b.cast("int"))),
        lambda v: F.col("key").bitwiseAND(v) == 0,
    )
    keys = F.concat(F.array("key"), F.transform(flips, lambda v: F.col("key").bitwiseOR(v)))
    probe = index.select(F.col("fp").alias("b"), F.col("ring").alias("ring_b"), F.explode(keys).alias("key"))
    x = F.col("ring").bitwiseXOR(F.col("ring_b"))
    place = F.shiftright("key", 2 * WIDTH)

    def differ(bits: Column) -> Column:
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1
        return F.bit_count(x.bitwiseAND(mask))

    three = F.when(place < 2, 3 * WIDTH).otherwise(3 * WIDTH - 1)
    four = F.when(place < 1, 4 * WIDTH).otherwise(4 * WIDTH - 1)
    chain = (differ(three) <= 2) & (differ(four) <= 3) & (F.bit_count(x) <= MAX_BITS)
    other = F.col("fp") != F.col("b")
    # Spark sizes a table that was exploded as before that: a few MB of fingerprints would be broadcast as many times their rows.
    left = index.withColumnRenamed("key", "key_a").hint("merge")
    return left.join(
        probe.hint("merge"), (F.col("key_a") == F.col("key")) & other & chain, "inner"
    ).select(F.col("fp").alias("a"), "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most four bits, the row's own
    included. Equal fingerprints meet before any join, so copies cost one row per task; no join
    shuffles the rows of a fingerprint, a group or a link's end that holds many of them.
    A text that is null, empty or white space has fingerprint zero and links like any other. Rows
    that share an id have one row each. A row without id keeps its fingerprint, and its
    ``component_id`` is the smallest id of its group, null if no row of the group has one.
    """
    prints = cut_lineage(fingerprints(docs, id_col, text_col), "prints")
    distinct = settle(
        prints.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "distinct"
    )
    groups = components(near_pairs(distinct), "a", "b")
    rooted = settle(
        distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
            "root", F.coalesce("root", "fp")
        ),
        "rooted",
    )
    least = rooted.groupBy("root").agg(
        F.min("least").alias("component_id"), F.count(F.lit(1)).alias("prints")
    )
    named = counted_join(rooted, settle(least, "roots"), "root", "prints")
    named = settle(named.select("fp", "component_id", "n"), "groups")
    return counted_join(prints, named, "fp", "n").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, with one document of each group: that with the smallest id.

    Of rows that share that id, the one with the smallest text stays. Rows without an id cannot be
    named and stay.
    """
    groups = near_duplicates(docs, id_col, text_col)
    first = F.col(id_col) == F.col("component_id")
    kept = groups.filter(first).select(F.col(id_col).alias("_keep")).distinct()
    named = docs.join(kept, docs[id_col] == kept["_keep"], "left_semi")
    order = Window.partitionBy(id_col).orderBy(F.col(text_col).asc_nulls_first())
    one = named.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")
    return one.unionByName(docs.filter(F.col(id_col).isNull()))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, with one row of each group: that with the smallest id, then the least hash of its text.

    Groups are those of the fingerprints, so rows that share an id but not their text are told apart. Rows without an id come
    last in their group. Of rows that share both id and text one stays. Null, empty and blank texts
    have fingerprint zero and are one group. An empty table stays empty.
    """
    rows, names = numbered_columns(docs)
    key = F.col(names[id_col])
    keyed = rows.withColumn("key", F.struct(key.isNull().alias("none"), key.alias("id"), F.xxhash64(names[text_col]).alias("text")))
    groups = near_duplicates(keyed.select("key", names[text_col]), "key", names[text_col])
    marked = groups.groupBy("key").agg(F.count_if(F.col("key") == F.col("component_id")).alias("times"))
    marked = cut_lineage(marked, "firsts")
    # Most rows stay. Those that go and those that repeat are named by few keys, and then no text is shuffled to meet its own.
    others = marked.filter("times != 1")
    if others.count() <= MAX_BROADCAST_KEYS:
        rest = keyed.join(F.broadcast(others), "key", "left_anti")
        repeated = keyed.join(F.broadcast(others.filter("times > 1")), "key", "left_semi").dropDuplicates(["key"])
        return named_back(rest.unionByName(repeated), names)
    kept = skewed_join(keyed, marked.filter("times > 0"), "key", "inner")
    one = kept.filter("times = 1").unionByName(kept.filter("times > 1").dropDuplicates(["key"]))
    return named_back(one, names)
