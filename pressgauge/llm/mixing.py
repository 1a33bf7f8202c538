"""Mixing sources to target weights: DataFrame functions only.

Words are summed per source, each source gets a target share of all words, and target over size is
its rate of repetition. A document is emitted ``floor(rate)`` times and once more with the
probability of the rest, by a hash of its id and a seed, so a rerun takes the same copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge.llm.lookup import group_join, named_back, numbered_columns
from pressgauge.operators.ids import assign_ids
from pressgauge.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in their order, from the start again when they end.
WEIGHTS = (5, 2, 1)
#: A target is at most this many times the size of its source.
MAX_RATE = 3
SEED = "mix-1"
# Hex digits of the hash, and the number of values that they take.
_DIGITS = 13
_VALUES = float(16**_DIGITS)
#: What plan() adds; a column of the documents with one of these names is replaced.
PLAN = ("size", "source_size", "target", "rate", "copies")


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _draw(key: Column) -> Column:
    """A number in [0, 1) that follows from the key and the seed."""
    digest = F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("bigint") / F.lit(_VALUES)


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE
) -> DataFrame:
    """(source, n, source_size, target) from (source, n, source_size), one row a source.

    Sources are numbered by code point, null last, and weigh ``weights`` in turn. They share the
    sum of all sizes by weight. A target stops at ``max_rate`` times its source's size; the excess
    goes to the others by weight, until none is above. The level (words per unit of weight) rises
    from round to round, so a source that has stopped stays stopped.
    """
    ordered = sizes.withColumn("_last", F.col("source").isNull())
    numbered = assign_ids(ordered, ["_last", "source"], start=0, id_col="_nth").drop("_last")
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("_nth") % len(weights) + 1).cast("int")
    )
    weighed = cut_lineage(numbered.withColumn("_w", weight).drop("_nth"), "weights")
    cap = F.col("source_size") * max_rate
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while total:
        over = F.col("_w") * F.lit(level) > cap
        row = weighed.agg(
            F.count_if(over).alias("n"),
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0)).alias("capped"),
            F.sum(F.when(~over, F.col("_w"))).alias("free"),
        ).first()
        if row["n"] == stopped:
            break
        stopped, level = row["n"], (total - row["capped"]) / row["free"]
    target = F.when(F.col("_w") * F.lit(level) > cap, cap.cast("double")).otherwise(
        F.lit(level) * F.col("_w")
    )
    return weighed.select("source", "n", "source_size", target.alias("target"))


def plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    max_rate: int = MAX_RATE,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``rate`` and ``copies``.

    A null or empty text has size 0. A null source is a source of its own, the last. Rows that
    share an id get the same copies; a null id is one id. Documents of a source without any word
    are emitted once. An empty table stays empty.
    """
    docs = docs.drop(*PLAN)
    sizes = cut_lineage(
        docs.groupBy(F.col(source_col).alias("source")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(word_count(F.col(text_col))).alias("source_size")
        ),
        "sizes",
    )
    targets = cut_lineage(source_targets(sizes, weights, max_rate), "targets")
    joined = group_join(
        docs, targets.withColumnsRenamed({"source": source_col, "n": "_n"}), source_col, "_n"
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    whole = F.floor("rate")
    extra = (_draw(F.col(id_col)) < F.col("rate") - whole).cast("bigint")
    return (
        joined.withColumn("size", word_count(F.col(text_col)))
        .withColumn("rate", rate)
        .withColumn("copies", whole + extra)
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **settings
) -> DataFrame:
    """The mixed rows with the columns of ``docs``: each document as often as its plan says.

    Columns that are called like those of the plan keep their values.
    """
    rows, names = numbered_columns(docs)
    planned = plan(rows, names[id_col], names[source_col], names[text_col], **settings)
    copies = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return named_back(planned.withColumn("_copy", copies), names)
