"""Named entities from rules and a gazetteer, chunk by chunk."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressgauge.functions.binding import let
from pressgauge.functions.text import clean_whitespace
from pressgauge.operators.chunks import explode_chunks, word_chunks
from pressgauge.operators.skew import skewed_join
from pressgauge.operators.word_groups import row_groups
from pressgauge.session import cut_lineage, ship_package

WORD = re.compile(r"\w+")
RUN = (("word", T.StringType()), ("start", T.IntegerType()), ("end", T.IntegerType()))
GROUPS = ("MISC", "LOC", "ORG", "PER")
HIT_NAMES = ("entity_group", "score", "word", "start", "end")
HIT = T.StructType(
    [
        T.StructField("entity_group", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("word", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("doc_start", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Rule:
    group: str
    pattern: str  # must not match the empty string


DEFAULT_RULES = (
    Rule("MISC", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
    Rule("MISC", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    Rule("ORG", r"\p{Lu}{4,}"),
    Rule("PER", r"\p{Lu}\p{Ll}+ \p{Lu}\p{Ll}+"),
    Rule("LOC", r"\p{Lu}\p{Ll}{5,}"),
)


def _spans(chunk: Column, rule: Rule) -> Column:
    """Hits of one rule with 0-based start and end inside the chunk.

    The gaps between the hits and the hits themselves alternate; a running length over
    both gives the offsets. A chunk is short, so the growing array stays small.
    """
    empty = F.array().cast("array<struct<entity_group:string,word:string,start:int,end:int>>")

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        hit = F.struct(
            F.lit(rule.group).alias("entity_group"),
            pair["hit"].alias("word"),
            start.alias("start"),
            end.alias("end"),
        )
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(hit)).alias("found"))

    def place(hits: Column) -> Column:
        gaps = F.split(chunk, rule.pattern, -1)
        pairs = F.zip_with(
            hits,
            F.slice(gaps, F.lit(1), F.size(hits)),
            lambda h, g: F.struct(h.alias("hit"), g.alias("gap")),
        )
        start = F.struct(F.lit(0).alias("at"), empty.alias("found"))
        spans = F.aggregate(pairs, start, step, lambda acc: acc["found"])
        return F.when(F.size(hits) > 0, spans).otherwise(empty)

    return let(F.regexp_extract_all(chunk, F.lit(rule.pattern), F.lit(0)), place)


def rule_entities(
    df: DataFrame,
    text: str,
    keep: Sequence[str] = ("index",),
    rules: Sequence[Rule] = DEFAULT_RULES,
    chunker: Callable[[Column], Column] = word_chunks,
) -> DataFrame:
    """One row per hit: kept columns, chunk_id, group, score, word, start, end, doc_start.

    ``start`` and ``end`` count from 0 inside the chunk, ``doc_start`` inside the cleaned
    text. Chunks overlap, so a hit in the overlap appears twice; consolidation keeps one.
    No shuffle. Articles without hits give no rows.
    """
    cleaned = df.select(*keep, clean_whitespace(F.col(text)).alias("_text"))
    chunks = explode_chunks(cleaned, chunker(F.col("_text")), *keep)
    found = F.flatten(F.array(*[_spans(F.col("chunk"), r) for r in rules]))
    return chunks.select(*keep, "chunk_id", "chunk_start", F.explode(found).alias("_e")).select(
        *keep,
        "chunk_id",
        F.col("_e.entity_group").alias("entity_group"),
        F.round(F.length("_e.word") / F.lit(100.0), 2).alias("score"),
        F.col("_e.word").alias("word"),
        F.col("_e.start").alias("start"),
        F.col("_e.end").alias("end"),
        (F.col("chunk_start") - 1 + F.col("_e.start")).cast("bigint").alias("doc_start"),
    )


def model_entities(
    df: DataFrame,
    text: str,
    load: Callable[[], Callable[[list[str]], list[list[dict]]]],
    keep: Sequence[str] = ("index",),
    chunker: Callable[[Column], Column] = word_chunks,
) -> DataFrame:
    """Entities from any recogniser, with the columns of ``rule_entities``.

    ``load`` runs once per task and returns a function from a list of chunks to a list of
    hits per chunk, each with entity_group, score, word, start and end.
    """
    cleaned = df.select(*keep, clean_whitespace(F.col(text)).alias("_text"))
    chunks = explode_chunks(cleaned, chunker(F.col("_text")), *keep)
    kept = chunks.select(*keep, "chunk_id").schema
    fields = [*kept.fields, *HIT.fields]

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        recognise = load()
        for batch in batches:
            found = recognise(batch["chunk"].tolist())
            rows = [
                (*batch.iloc[i][[*keep, "chunk_id"]], *(hit[n] for n in HIT_NAMES),
                 int(batch["chunk_start"].iloc[i]) - 1 + hit["start"])
                for i, hits in enumerate(found)
                for hit in hits
            ]
            yield pd.DataFrame(rows, columns=[f.name for f in fields])

    return chunks.mapInPandas(find, T.StructType(fields))


def _words_of_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_group, _text) to (_of, word): the distinct words of each group in a batch."""
    for batch in batches:
        found: dict[int, set[str]] = {}
        for group, text in zip(batch.column(0), batch.column(1)):
            found.setdefault(group.as_py(), set()).update(WORD.findall(text.as_py() or ""))
        for group, own in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([group] * len(own), pa.int64()), pa.array(list(own), pa.string())], names=["_of", "word"])


def gazetteer_entities(
    df: DataFrame, text: str, gazetteer: DataFrame, keep: Sequence[str] = ("index",)
) -> DataFrame:
    """Hits of a gazetteer (word, entity_group, score) on runs of words as long as its longest name.

    Each mention counts once; ``start`` and ``end`` count from 0 in the cleaned text; a word is a run of letters, digits and underscores, and between words
    anything else may stand. A group of texts first meets the words that stand in names, each once; only runs
    of such words are made and joined with the names, so the work grows with the text and not with text times gazetteer.
    """
    ship_package(df.sparkSession)
    # Written once: it is read for the words of names, the longest name and the join, and may be found in all texts.
    gazetteer = cut_lineage(gazetteer.select("word", "entity_group", "score"), "gazetteer")
    cleaned = clean_whitespace(F.col(text))
    texts = cut_lineage(df.select(*keep, cleaned.alias("_text"), row_groups(df, text).alias("_group")), "texts")
    size = F.size(F.split(F.trim("word"), r"\s+"))
    longest = gazetteer.agg(F.greatest(F.lit(1), F.coalesce(F.max(size), F.lit(1))).alias("n")).scalar()
    in_names = gazetteer.select(F.explode(F.split("word", " ")).alias("word")).distinct()
    words = texts.select("_group", "_text").mapInArrow(_words_of_groups, "_of bigint, word string").distinct()
    fields = [*texts.select(*keep).schema.fields, *(T.StructField(n, t) for n, t in RUN)]
    names = [f.name for f in fields]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known = set(right.column("word").to_pylist())
        rows, words, starts, ends = [], [], [], []
        most = left.column("_longest")[0].as_py()
        for row, value in enumerate(left.column("_text") if known else ()):
            open_runs: list[tuple[int, int]] = []  # (start, words) of the runs that end with the word before
            text = value.as_py() or ""
            own: list[str] = []
            for found in WORD.finditer(text):
                word = found.group()
                if word not in known:
                    own, open_runs = [], []
                    continue
                own = [*own[1 - most :], word] if most > 1 else [word]
                open_runs = [(start, n + 1) for start, n in open_runs if n < most] + [(found.start(), 1)]
                for start, n in open_runs:
                    rows.append(row)
                    words.append(" ".join(own[-n:]))
                    starts.append(start)
                    ends.append(found.end())
        kept = left.select(list(keep)).take(pa.array(rows, pa.int64()))
        made = [pa.array(words, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())]
        return pa.Table.from_arrays([*kept.columns, *made], names=names)

    placed = texts.withColumn("_longest", longest)
    phrases = placed.groupBy("_group").cogroup(words.join(in_names, "word").groupBy("_of")).applyInArrow(run, T.StructType(fields))
    found = cut_lineage(phrases, "runs")
    return skewed_join(found, gazetteer, "word", "inner").select(
        *keep, "entity_group", "score", "word", "start", "end"
    )
