"""Overlapping chunks of long texts: 400 characters with 60 of overlap by default."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge.functions.binding import let

CHUNK_SIZE = 400
CHUNK_OVERLAP = 60
#: Characters of text whose chunks are Python objects at once.
CHARACTERS = 1 << 20


def fixed_chunks(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Array of (start, chunk) at every ``size - overlap`` characters, in the JVM.

    The text is cut once into strides; a chunk is its stride plus the head of the next
    one. A last stride that the previous chunk already covers makes no chunk. The
    overlap may not exceed the stride.
    """
    step = size - overlap

    def from_strides(strides: Column) -> Column:
        covered = (F.size(strides) > 1) & (
            F.length(F.try_element_at(strides, F.lit(-1))) <= overlap
        )
        chunks = F.transform(
            strides,
            lambda s, i: F.struct(
                (i * step + 1).cast("int").alias("start"),
                F.concat(
                    s, F.coalesce(F.substring(F.get(strides, i + 1), 1, overlap), F.lit(""))
                ).alias("chunk"),
            ),
        )
        return F.slice(chunks, F.lit(1), F.size(strides) - covered.cast("int"))

    return let(
        F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{step}}}"), F.lit(0)), from_strides
    )


def _cut_at_words(text: str, size: int, overlap: int) -> list[dict]:
    """Greedy chunks of whole words; a word of ``size`` or more is cut by characters."""
    pieces, at = [], 0  # (start, end, may it be merged)
    for n, word in enumerate(text.split(" ")):
        begin = at if n == 0 else at - 1  # a piece owns the blank before it
        at += len(word) + 1
        if at - 1 > begin:
            pieces.append((begin, at - 1))
    spans: list[tuple[int, int]] = []
    first = last = None  # open window of pieces [first, last]
    for i, (begin, end) in enumerate(pieces):
        if end - begin >= size:
            if first is not None:
                spans.append((pieces[first][0], pieces[last][1]))
                first = None
            step = size - overlap
            tail = max(end - begin - overlap, 1)
            spans.extend((b, min(b + size, end)) for b in range(begin, begin + tail, step))
            continue
        if first is not None and end - pieces[first][0] > size:
            spans.append((pieces[first][0], pieces[last][1]))
            while first < i and (
                begin - pieces[first][0] > overlap or end - pieces[first][0] > size
            ):
                first += 1
        if first is None:
            first = i
        last = i
    if first is not None:
        spans.append((pieces[first][0], pieces[last][1]))
    found = []
    for begin, end in spans:
        raw = text[begin:end]
        chunk = raw.strip()
        if chunk:
            start = begin + len(raw) - len(raw.lstrip()) + 1
            found.append({"start": start, "chunk": chunk})
    return found


def word_chunks(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Array of (start, chunk) that breaks at blanks.

    Where a chunk starts depends on where the previous one ended, which no built-in
    expresses in linear time; texts travel to Python in Arrow batches, row by row
    independent, so there is no shuffle. Of a batch, the chunks of ``CHARACTERS`` of text
    at a time are Python objects.
    """
    kind = pa.list_(pa.struct([("start", pa.int32()), ("chunk", pa.string())]))

    @F.arrow_udf("array<struct<start:int,chunk:string>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            done, rows, held = [], [], 0
            for text in texts:
                text = text.as_py()
                rows.append(None if text is None else _cut_at_words(text, size, overlap))
                held += len(text or "")
                if held > CHARACTERS:
                    done.append(pa.array(rows, kind))
                    rows, held = [], 0
            done.append(pa.array(rows, kind))
            yield pa.concat_arrays(done)

    return cut(text)


def explode_chunks(df: DataFrame, chunks: Column, *keep: str) -> DataFrame:
    """One row per chunk with ``chunk_id`` (from 0), ``chunk_start`` and ``chunk``."""
    return df.select(*keep, F.posexplode(chunks).alias("chunk_id", "_c")).select(
        *keep, "chunk_id", F.col("_c.start").alias("chunk_start"), F.col("_c.chunk").alias("chunk")
    )
