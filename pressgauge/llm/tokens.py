"""Token counts by a two-tier lookup of pre-tokens; nothing is shuffled.

A pre-token here is what stands between white space: the tokenizer drops white space and joins
nothing across it, so the count of a text is the sum over its pre-tokens. The first tier is a
broadcast table with the counts of the tokenizer's own complete words, which are the frequent words of
the text it was made from; it has at most one entry per vocabulary item. The second tier is a cache
in each worker process: a pre-token that is in neither is encoded by the tokenizer once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_END = "</w>"
#: A worker forgets its cache beyond this many pre-tokens or characters and starts anew.
CACHE_WORDS = 1_000_000
CACHE_CHARS = 32_000_000
#: White space for str.split that the tokenizer's pattern takes for ordinary characters.
SEPARATORS = "\x1c\x1d\x1e\x1f"

#: Per worker process and tokenizer file: the tokenizer and the counts known so far.
_workers: dict[str, "Counter"] = {}


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, inverted.

    Printable bytes stand for themselves, the others follow from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in printable}
    rest = [b for b in range(256) if b not in set(printable)]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter:
    """Counts tokens of texts with one tokenizer."""

    def __init__(self, path: str, frequent: dict[str, int]):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.frequent = frequent
        self.seen: dict[str, int] = {}
        self.chars = 0

    def encode(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, text: str) -> int:
        if any(c in text for c in SEPARATORS):
            return self.encode([text])[0]
        words = text.split()
        found = list(map(self.frequent.get, words, repeat(-1)))
        if -1 not in found:
            return sum(found)
        misses = [w for w, n in zip(words, found) if n < 0]
        known = self.seen
        new = {w for w in misses if w not in known}
        if new:
            if len(known) + len(new) > CACHE_WORDS or self.chars + len(text) > CACHE_CHARS:
                known, self.chars, new = {}, 0, set(misses)
                self.seen = known
            order = list(new)
            known.update(zip(order, self.encode(order)))
            self.chars += sum(map(len, order))
        return sum(found) + len(misses) + sum(map(known.__getitem__, misses))


def frequent_counts(path: str) -> dict[str, int]:
    """Counts of the complete words of the vocabulary, as the tokenizer itself encodes them."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    letters = _byte_letters()
    words = set()
    for item in tokenizer.get_vocab(with_added_tokens=False):
        if item.endswith(WORD_END):
            raw = bytes(letters[c] for c in item.removesuffix(WORD_END) if c in letters)
            word = raw.decode("utf-8", "ignore")
            if word and len(word.split()) == 1 and not any(c in word for c in SEPARATORS):
                words |= {word, word.capitalize()}
    words = sorted(words)
    return dict(zip(words, (len(e) for e in tokenizer.encode_batch_fast(words, add_special_tokens=False))))


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens): UTF-8 bytes and tokens of every whole text.

    ``path`` is a tokenizer file whose pre-tokenizer drops white space; every machine has it. No token is
    added; a special token's string inside a text is that token. A null or empty text has 0 of
    both. Rows that share an id have one row each; a null id is kept.
    """
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(frequent_counts(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pressgauge.llm import tokens

        if path not in tokens._workers:
            tokens._workers[path] = tokens.Counter(path, shared.value)
        count = tokens._workers[path].count
        for batch in batches:
            found = [count(t) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.int64())],
                names=[id_col, "n_bytes", "n_tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint")
    return docs.select(id_col, text_col, size.alias("n_bytes")).mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint"
    )
