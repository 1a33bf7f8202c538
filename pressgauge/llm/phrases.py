"""Phrases whose words belong together, mined by SON partitioning.

A phrase with ``support`` occurrences in all has, in some shard, at least the part of ``support`` that is the shard's part
of the words. So every shard is mined completely at that lowered support, level by level: a phrase of k
words is counted in a shard if both its phrases of k - 1 words are frequent there. The union of what is frequent in some
shard is counted over all texts exactly, but for phrases that cannot reach ``support``: a shard where a phrase was not counted has
less than its local support of it. Shards are few, so that the lowered support stays well above one; each is
spread over many tasks. Mining counts hashes and remembers frequent ones as bits of a table of fixed size:
equal hashes and equal bits only add phrases to the exact count, which drops them.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressgauge.llm.links import settle
from pressgauge.llm.lookup import group_join
from pressgauge.llm.scan import Words, grams, mix, pieces, utf8
from pressgauge.operators.skew import skewed_join
from pressgauge.session import cut_lineage

SUPPORT = 10
LEAST_WORDS, MOST_WORDS = 2, 3
#: A candidate goes if a longer one that holds it has this share (%) of its occurrences.
COVERED = 50
TOP = 2_000
SCORE_SCALE = 1_000_000
NO_LANG = "und"
#: Shards have a local support of about this many.
LOCAL_SUPPORT = 5
#: Bits of the table of frequent phrases, per shard.
FILTER_BITS = 26
#: A task hands its counts on beyond this many entries.
TASK_ENTRIES = 2_000_000
#: And of whole phrases beyond this many.
HELD_PHRASES = 800_000
_SHARD_BITS = 16

# What ends a piece, and what ends a word inside one.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"
WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
_BETWEEN = np.zeros(256, bool)
_BETWEEN[list(PIECE_ENDS + WORD_ENDS)] = True
_BREAK = np.zeros(256, bool)
_BREAK[list(PIECE_ENDS)] = True


class _Runs:
    """Words of several texts with the runs of words that lie in one piece."""

    def __init__(self, texts: list[bytes], langs: np.ndarray):
        self.words = Words(texts, _BETWEEN, lower=True)
        self.of = self.words.texts_of()
        breaks = np.flatnonzero(_BREAK[self.words.data])
        piece = np.searchsorted(breaks, self.words.starts)
        self.next = np.zeros(len(piece), bool)
        self.next[:-1] = (piece[1:] == piece[:-1]) & (self.of[1:] == self.of[:-1])
        self.hash, self.lang = self.words.hashes(), langs

    def starts(self, k: int) -> np.ndarray:
        """Numbers of the words that begin a phrase of ``k`` words."""
        whole = np.ones(max(0, len(self.next) - k + 1), bool)
        for j in range(k - 1):
            whole &= self.next[j : j + len(whole)]
        return np.flatnonzero(whole)

    def grams(self, k: int) -> np.ndarray:
        """Hash of the run of ``k`` words from each word on, its language included; runs over a border as well."""
        h = grams(self.hash, k)
        return mix(h + self.lang[self.of[: len(h)]])


def _tally(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their counts."""
    kinds, inverse = np.unique(keys, return_inverse=True)
    return kinds, np.bincount(inverse, counts, minlength=len(kinds)).astype(np.int64)


def _keyed(h: np.ndarray, shards: np.ndarray) -> np.ndarray:
    """Hashes with their lowest bits given to the shard."""
    low = np.uint64((1 << _SHARD_BITS) - 1)
    return (h & ~low) | shards.astype(np.uint64)


class _Table:
    """Bits of the frequent phrases of every shard."""

    def __init__(self, bits: np.ndarray, filter_bits: int):
        self.bits, self.filter_bits = bits, filter_bits

    def __getstate__(self) -> tuple:
        """Few bits are set in small corpora, so they are sent packed."""
        return self.bits.shape, self.filter_bits, zlib.compress(self.bits.tobytes(), 1)

    def __setstate__(self, state: tuple) -> None:
        shape, self.filter_bits, packed = state
        self.bits = np.frombuffer(zlib.decompress(packed), np.uint64).reshape(shape)

    def has(self, h: np.ndarray, shards: np.ndarray | None = None) -> np.ndarray:
        """Is the hash set for its shard, or (without shards) for any?"""
        place = h >> np.uint64(64 - self.filter_bits)
        word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
        if shards is not None:
            return (self.bits[shards, word] >> bit & np.uint64(1)).astype(bool)
        found = np.zeros(len(h), bool)
        for row in self.bits:
            found |= (row[word] >> bit & np.uint64(1)).astype(bool)
        return found


def _table(frequent: DataFrame, shards: int, filter_bits: int) -> Broadcast:
    """Broadcast table of the column ``base`` for the numbers in ``in_shards``; its size follows from the shards and bits alone."""
    place = F.shiftrightunsigned("base", 64 - filter_bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
    each = frequent.select(F.explode("in_shards").alias("shard"), "base")
    words = each.groupBy("shard", F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = words.toArrow()
    bits = np.zeros((shards, max(1, 1 << filter_bits >> 6)), np.uint64)
    bits[found["shard"].to_numpy(), found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return frequent.sparkSession.sparkContext.broadcast(_Table(bits, filter_bits))


_CODEC = pa.Codec("zstd", compression_level=1)


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and their counts: steps from key to key by bytes of equal weight, most of which are zero, then the counts likewise."""
    steps = np.diff(keys, prepend=np.uint64(0))
    planes = [np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T) for x in (steps, counts)]
    return _CODEC.compress(b"".join(p.tobytes() for p in planes), asbytes=True)


def _unpacked(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(_CODEC.decompress(data, 16 * n, asbytes=True), np.uint8).reshape(2, 8, n)
    steps, counts = (np.ascontiguousarray(x.T).view("<u8").ravel() for x in raw)
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


def _mined(docs: DataFrame, k: int, parts: Broadcast | None, shards: int, ranges: int) -> DataFrame:
    """(range, size, packed, need_0, ...): phrases of ``k`` words per shard whose parts are frequent in it, as each task counted them.

    A task hands on one sorted array for each range of hashes.
    """
    needs = [f"need_{i}" for i in range(shards)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[tuple[np.ndarray, np.ndarray]]] = {}
        entries = 0

        def hand_on() -> Iterator[pa.RecordBatch]:
            for need, some in held.items():
                keys, counts = _tally(np.concatenate([a for a, _ in some]), np.concatenate([b for _, b in some]))
                of = (keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
                edges = np.searchsorted(of, np.arange(ranges + 1, dtype=np.uint64)).tolist()
                rows = [(i, b - a, _packed(keys[a:b], counts[a:b])) for i, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
                if rows:
                    number, size, packed = zip(*rows)
                    columns = [pa.array([n] * len(rows), pa.int64()) for n in need]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(number, pa.int32()), pa.array(size, pa.int64()), pa.array(packed, pa.binary()), *columns], names=["range", "size", "packed", *needs]
                    )
            held.clear()

        for batch in batches:
            texts, wanted = utf8(batch.column(0)), list(zip(*(batch.column(i).to_pylist() for i in range(3, 3 + shards))))
            lang_hash = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            shard = batch.column(2).to_numpy(zero_copy_only=False)
            for a, b in pieces(texts):
                runs = _Runs(texts[a:b], lang_hash[a:b])
                at = runs.starts(k)
                h, of = runs.grams(k), runs.of
                if parts is not None and len(at):
                    shorter = parts.value.has(runs.grams(k - 1), shard[a:b][of[: len(runs.hash) - k + 2]])
                    at = at[shorter[at] & shorter[at + 1]]
                group: dict[tuple, int] = {}
                group_of = np.array([group.setdefault(x, len(group)) for x in wanted[a:b]], np.int64)
                keys, belongs = _keyed(h[at], shard[a:b][of[at]]), group_of[of[at]]
                for need, i in group.items():
                    mine = keys[belongs == i]
                    tally = _tally(mine, np.ones(len(mine)))
                    held.setdefault(need, []).append(tally)
                    entries += len(tally[0])
                if entries > TASK_ENTRIES:
                    yield from hand_on()
                    entries = 0
        yield from hand_on()

    schema = "range int, size bigint, packed binary, " + ", ".join(f"{c} bigint" for c in needs)
    return docs.select("text", "lang_hash", "shard", *needs).mapInArrow(run, schema)


def _possible(mined: DataFrame, shards: int, support: int) -> DataFrame:
    """(base, in_shards): hashes that are frequent in some shard, with these shards, and may have ``support`` in all.

    A range's arrays of all tasks are added up in one task; ranges are as many as shuffle partitions, and hashes fill them evenly.
    """

    def run(table: pa.Table) -> pa.Table:
        low = np.uint64((1 << _SHARD_BITS) - 1)
        sizes = table.column("size").to_pylist()
        found = [_unpacked(data, n) for data, n in zip(table.column("packed").to_pylist(), sizes)]
        keys, counts = (np.concatenate(x) for x in zip(*found))
        wanted = np.stack([np.repeat(table.column(f"need_{i}").to_numpy(), sizes) for i in range(shards)])
        order = np.argsort(keys, kind="stable")
        keys, counts, wanted = keys[order], counts[order], wanted[:, order]
        base, shard = keys & ~low, (keys & low).astype(np.int64)
        begins = np.flatnonzero(np.concatenate(([True], base[1:] != base[:-1])))
        need = np.minimum.reduceat(wanted, begins, axis=1)
        n = np.stack([np.add.reduceat(np.where(shard == i, counts, 0), begins) for i in range(shards)])
        most = np.where(n > 0, n, need - 1).sum(axis=0)
        frequent = n >= need
        kept = np.flatnonzero(frequent.any(axis=0) & (most >= support))
        inside = [np.flatnonzero(frequent[:, i]).tolist() for i in kept]
        return pa.table({"base": pa.array(base[begins][kept].view(np.int64)), "in_shards": pa.array(inside, pa.list_(pa.int32()))})

    return mined.groupBy("range").applyInArrow(run, "base bigint, in_shards array<int>")


def _counted(docs: DataFrame, tables: list[Broadcast]) -> DataFrame:
    """(lang, phrase, n): exact counts of all phrases that the tables of levels 1, 2, ... may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def hand_on(most: float) -> Iterator[pa.RecordBatch]:
            """Entries with at most so many occurrences; the others are likely to come again and stay."""
            for lang, counts in held.items():
                phrases = [p for p, n in counts.items() if n <= most]
                n = [counts.pop(p) for p in phrases]
                for at in range(0, len(phrases), 100_000):
                    some = phrases[at : at + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(some), pa.string()), pa.array(some, pa.binary()).cast(pa.string()), pa.array(n[at : at + 100_000], pa.int64())],
                        names=["lang", "phrase", "n"],
                    )

        for batch in batches:
            texts, langs = utf8(batch.column(0)), batch.column(2).to_pylist()
            lang_hash = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for a, b in pieces(texts):
                runs = _Runs(texts[a:b], lang_hash[a:b])
                starts, ends = runs.words.starts, runs.words.ends
                data = runs.words.data.tobytes()
                plain = np.concatenate((ends[:-1] + 1 == starts[1:], [True])) & (runs.words.data[np.minimum(ends, len(data) - 1)] == 0x20)
                code = {lang: i for i, lang in enumerate(dict.fromkeys(langs[a:b]))}
                lang_of = np.array([code[x] for x in langs[a:b]], np.int64)
                for k, table in enumerate(tables, 1):
                    at = runs.starts(k)
                    at = at[table.value.has(runs.grams(k)[at])]
                    # Words with more than a space between them are joined one by one.
                    simple = np.ones(len(at), bool)
                    for j in range(k - 1):
                        simple &= plain[at + j]
                    for lang, i in code.items():
                        mine = lang_of[runs.of[at]] == i
                        counts = held.setdefault(lang, Counter())
                        some = at[mine & simple]
                        counts.update(map(data.__getitem__, map(slice, starts[some].tolist(), ends[some + k - 1].tolist())))
                        some = at[mine & ~simple]
                        counts.update(b" ".join(data[x:y].split()) for x, y in zip(starts[some].tolist(), ends[some + k - 1].tolist()))
                if sum(map(len, held.values())) > HELD_PHRASES:
                    yield from hand_on(1)
                    if sum(map(len, held.values())) > HELD_PHRASES // 2:
                        yield from hand_on(np.inf)
        yield from hand_on(np.inf)

    return docs.select("text", "lang_hash", "lang").mapInArrow(run, "lang string, phrase string, n bigint").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _needs(sizes: DataFrame, shards: int, support: int) -> DataFrame:
    """(lang, n, n_docs, need_0, ...): the part of ``support`` words that each shard's words are of all words of its language, one at least."""
    words = [F.coalesce(F.sum(F.when(F.col("shard") == i, F.col("n_words"))), F.lit(0)).alias(f"w_{i}") for i in range(shards)]
    whole = sizes.groupBy("lang").agg(F.sum("n_words").alias("n"), F.sum("n_docs").alias("n_docs"), *words)
    part = "greatest(1L, cast((cast({s} as decimal(10,0)) * cast(w_{i} as decimal(19,0)) + greatest(n, 1L) - 1) div greatest(n, 1L) as bigint)) AS need_{i}"
    return whole.selectExpr("lang", "n", "n_docs", *[part.format(s=support, i=i) for i in range(shards)])


def phrase_counts(
    docs: DataFrame, support: int = SUPPORT, most_words: int = MOST_WORDS, filter_bits: int = FILTER_BITS,
    shards: int | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all phrases of up to ``most_words`` words with ``support`` occurrences, and (lang, n) of all words."""
    shards = shards or max(1, min(1 << _SHARD_BITS, support // LOCAL_SUPPORT))
    lang = F.coalesce(F.col(lang_col), F.lit(NO_LANG))
    text = F.coalesce(F.col(text_col), F.lit(""))
    shard = F.pmod(F.xxhash64(F.col(id_col), text), F.lit(shards)).cast("bigint")
    rows = docs.select(text.alias("text"), lang.alias("lang"), F.xxhash64(lang).alias("lang_hash"), shard.alias("shard"))
    sizes = rows.groupBy("lang", "shard").agg(F.sum(F.regexp_count("text", F.lit(WORD))).alias("n_words"), F.count(F.lit(1)).alias("n_docs"))
    needs = settle(_needs(sizes, shards, support), "needs")
    wide = group_join(rows, needs.drop("n"), "lang", "n_docs")
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tables: list[Broadcast] = []
    for k in range(1, most_words + 1):
        mined = _mined(wide, k, tables[-1] if tables else None, shards, ranges)
        tables.append(_table(_possible(mined, shards, support), shards, filter_bits))
    counts = cut_lineage(_counted(rows, tables).filter(F.col("n") >= support), "phrases")
    return counts, needs.select("lang", "n")


def _words_of(phrase: Column) -> Column:
    return F.split(phrase, " ")


def _inside(phrase: str, least: int) -> Column:
    """All runs of at least ``least`` words of a phrase that are shorter than it."""
    words = f"split({phrase}, ' ')"
    return F.expr(
        f"flatten(transform(sequence(1, size({words})), i -> transform(filter(sequence({least}, greatest({least}, size({words}) - 1)),"
        f" k -> k < size({words}) and i + k - 1 <= size({words})), k -> array_join(slice({words}, i, k), ' '))))"
    )


def collocations(
    docs: DataFrame, support: int = SUPPORT, least_words: int = LEAST_WORDS, most_words: int = MOST_WORDS, covered: int = COVERED,
    top: int = TOP, **settings,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language.

    Texts are lower-cased (A-Z) and cut into pieces at ``PIECE_ENDS``; a phrase lies in one piece, its words joined by one space.
    ``a`` is its number of occurrences, ``l`` and ``r`` those of the two parts of its cut with the least
    score floor(10^6 a a / (l r)), of equal ones the first; ``n`` counts all words of the language. A phrase goes if a longer
    candidate that holds it has at least ``covered`` percent of its occurrences. Ranks go by score and ``a``, both descending, then
    the phrase in byte order. A null text is empty, a null language is ``und``, repeated rows count as often as they
    come, rows without an id too. Other columns are not read; an empty table gives an empty table.
    """
    counts, totals = phrase_counts(docs, support, most_words, **settings)
    n_words = F.size(_words_of(F.col("phrase")))
    found = counts.filter(n_words >= least_words).withColumnRenamed("n", "a")
    parts = F.expr(
        "transform(sequence(1, size(split(phrase, ' ')) - 1), k -> named_struct('k', k, 'left', array_join(slice(split(phrase, ' '), 1, k), ' '),"
        " 'right', array_join(slice(split(phrase, ' '), k + 1, size(split(phrase, ' ')) - k), ' ')))"
    )
    cuts = found.select("lang", "phrase", "a", F.explode(parts).alias("c")).select("lang", "phrase", "a", "c.k", "c.left", "c.right")
    known = counts.select(F.struct("lang", "phrase").alias("part"), F.col("n").alias("found"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cut_lineage(
            skewed_join(cuts.withColumn("part", F.struct("lang", F.col(side).alias("phrase"))), known, "part", "inner")
            .withColumnRenamed("found", name).drop("part", side), f"cut-{side}",
        )
    score = F.expr(
        f"(cast({SCORE_SCALE} as decimal(8,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)))"
        " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    )
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s"))
    longer = found.filter(n_words > least_words).select(
        "lang", F.explode(F.array_distinct(_inside("phrase", least_words))).alias("phrase"), "a"
    ).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = scored.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a"))
    )
    flat = free.select("lang", "phrase", "a", F.col("s.l").alias("l"), F.col("s.r").alias("r"), F.col("s.score").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The best of every slice of a language first, so that no task sorts a whole language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    best = flat.withColumn("part", part).withColumn("nth", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = best.filter(F.col("nth") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.filter(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
