"""Document fingerprints by context-triggered piecewise hashing.

A hash of the last seven bytes rolls over the text. Where it ends in ``k`` zero bits a chunk ends, so
chunks are about ``2**k`` bytes long and depend on the text around their ends only. Each chunk gives one
character of the signature. ``k`` is the least block level with at most 64 chunks; a fingerprint is
``k:signature:signature at k + 1``. Signatures of the same level are compared by edit distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import IntegerType, StringType

from pressgauge.llm.scan import mix, pieces, utf8

CONTEXT = 7
LEAST_LEVEL, MOST_LEVEL = 2, 40
SIGNATURE = 64
# The letters of base 64.
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
_POWER = np.uint64(0x100000001B3)
_FIRST = -(1 << 63)


def fingerprints_of(texts: list[bytes]) -> list[str]:
    """Fingerprints of several texts in one go."""
    gap = bytes(CONTEXT)
    data = np.frombuffer(gap + b"".join(t + gap for t in texts), dtype=np.uint8).astype(np.uint64)
    rolled = data.copy()
    powers = np.cumprod(np.full(CONTEXT, _POWER))
    for back in range(1, CONTEXT):
        rolled[back:] += data[:-back] * powers[back]
    rolled = mix(rolled)
    low = rolled & (~rolled + np.uint64(1))
    level = np.minimum(np.bitwise_count(low - np.uint64(1)), MOST_LEVEL).astype(np.int64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(rolled)))
    out, at = [], CONTEXT
    for text in texts:
        n = len(text)
        own = level[at : at + n]
        ends = np.flatnonzero(own >= LEAST_LEVEL)
        of = own[ends]
        more = np.bincount(of, minlength=MOST_LEVEL + 2)[::-1].cumsum()[::-1]
        fit = np.flatnonzero(more[LEAST_LEVEL:] < SIGNATURE)
        k = LEAST_LEVEL + int(fit[0])
        signatures = []
        for least in (k, k + 1):
            cuts = ends[of >= least] + 1
            if n and (not len(cuts) or cuts[-1] != n):
                cuts = np.append(cuts, n)
            totals = sums[at + cuts] - sums[np.concatenate(([at], at + cuts[:-1]))] if n else sums[:0]
            signatures.append(LETTERS[(mix(totals) >> np.uint64(58)).astype(np.int64)].tobytes().decode())
        out.append(f"{k}:{signatures[0]}:{signatures[1]}")
        at += n + CONTEXT
    return out


@arrow_udf(StringType())
def fingerprint(texts: pa.Array) -> pa.Array:
    """Fingerprint column of a text column; null is empty, and an empty text has empty signatures."""
    raw = utf8(texts)
    return pa.array([f for a, b in pieces(raw) for f in fingerprints_of(raw[a:b])], pa.string())


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: one minus the edit distance over the longer signature, at a block level both have.

    Equal levels compare both signatures and take the better; neighbouring levels compare the level they
    share; others give 0. Equal fingerprints give 1. A null gives null.
    """
    one, two = F.split(a, ":"), F.split(b, ":")

    def alike(x: Column, y: Column) -> Column:
        longest = F.greatest(F.length(x), F.length(y))
        return F.when(longest == 0, 0.0).otherwise(1 - F.levenshtein(x, y) / longest)

    k, m = one[0].cast("int"), two[0].cast("int")
    return (
        F.when(a == b, 1.0)
        .when(k == m, F.greatest(alike(one[1], two[1]), alike(one[2], two[2])))
        .when(k == m + 1, alike(one[1], two[2]))
        .when(k + 1 == m, alike(one[2], two[1]))
        .when(a.isNotNull() & b.isNotNull(), 0.0)
    )


def _placed(docs: DataFrame) -> DataFrame:
    """Rows of (id, key, text) dealt into ranges of the key, each with the first row of the next range as a guest.

    The bounds are numbers on the driver, one per shuffle partition. The range after the last is the first.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / parts for i in range(1, parts)]
    keys = docs.select("key")
    bounds = sorted(set((keys.agg(F.percentile_approx("key", cuts, 10_000)).first()[0] if cuts else []) or []))
    at = np.array(bounds, np.int64)

    @arrow_udf(IntegerType())
    def bucket(key: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(at, key.to_numpy(), side="right"), pa.int32())

    least = keys.groupBy(bucket("key").alias("b")).agg(F.min("key").alias("k")).collect()
    order = sorted((r["b"], r["k"]) for r in least)
    guests: dict[int, int] = {key: order[i - 1][0] for i, (_, key) in enumerate(order)}
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(1).to_numpy()
            own = np.searchsorted(at, key, side="right").astype(np.int32)
            also = np.flatnonzero(np.isin(key, list(guests)))
            rows = pa.array(np.concatenate((np.arange(len(key)), also)))
            to = np.concatenate((own, np.array([guests[int(key[i])] for i in also], np.int32)))
            guest = np.concatenate((np.zeros(len(key), np.int32), np.ones(len(also), np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(to), pa.array(guest), *(c.take(rows) for c in batch.columns)],
                names=["bucket", "guest", "id", "key", "text"],
            )

    return (
        docs.select("id", "key", "text")
        .mapInArrow(run, f"bucket int, guest int, id {kind}, key bigint, text string")
        .repartitionById(parts, "bucket")
        .sortWithinPartitions("bucket", "guest", "key", "text")
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, next_fingerprint) of every row.

    The edited text has its last quarter (rounded down) replaced by as much of the beginning of the
    next text in ascending order of the integer id, or all of it; after the last comes the first. A null text is empty. A null id comes before
    all others; rows that share an id follow one another by their texts. Of a single row, the next is itself.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_FIRST)).alias("key"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the row before, whose next has not come yet

        for batch in batches:
            texts = batch.column(4).to_pylist()
            raw = [t.encode() for t in texts]
            for a, b in pieces(raw):
                prints = fingerprints_of(raw[a:b])
                bucket, guest = batch.column(0)[a:b].to_pylist(), batch.column(1)[a:b].to_pylist()
                seen = held + list(zip(bucket, guest, batch.column(2)[a:b], texts[a:b], prints))
                held = seen[-1:]
                made = []
                for one, two in zip(seen, seen[1:]):
                    if one[0] != two[0] or one[1]:
                        continue
                    n = len(one[3])
                    edited = one[3][: n - n // 4] + two[3][: n // 4]
                    made.append((one[2], n, edited.encode(), one[4], two[4]))
                if made:
                    changed = fingerprints_of([m[2] for m in made])
                    shas = [hashlib.sha256(m[2]).hexdigest() for m in made]
                    ids = pa.array([m[0].as_py() for m in made], batch.column(2).type)
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([m[1] for m in made], pa.int64()), *map(pa.array, (shas, [m[3] for m in made], changed, [m[4] for m in made]))],
                        names=names,
                    )

    out = f"id {kind}, n_chars bigint, " + ", ".join(f"{n} string" for n in names[2:])
    return _placed(rows).mapInArrow(run, out).withColumnRenamed("id", id_col)
