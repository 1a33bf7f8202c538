"""Byte-level scanning of whole texts with numpy, shared by the operators that run in Python workers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# The six white space characters that end a word.
WORD_ENDS = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)
SPACE = np.zeros(256, dtype=bool)
SPACE[list(WORD_ENDS)] = True
#: ASCII that is neither letter nor digit; what stands between is a bare word. Other bytes are letters.
NOT_LETTER = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)
#: Texts are taken together up to this many bytes; a longer one is a piece of its own.
PIECE_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def pieces(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``PIECE_BYTES`` each."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > PIECE_BYTES:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of several texts: byte offsets into ``data`` and the first word of each text."""

    def __init__(self, texts: list[bytes], between: np.ndarray = SPACE, lower: bool = False):
        self.raw = b" ".join(texts) + b" "
        self.data = np.frombuffer(self.raw, dtype=np.uint8)
        if lower:
            self.data = LOWER[self.data]
        inside = np.zeros(len(self.data) + 1, dtype=np.int8)
        inside[1:] = ~between[self.data]
        steps = np.diff(inside)
        self.starts = np.flatnonzero(steps == 1)
        self.ends = np.flatnonzero(steps == -1)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))
        self.first = np.searchsorted(self.starts, self.offsets)

    def texts_of(self) -> np.ndarray:
        """The number of the text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, most: int | None = None) -> np.ndarray:
        """A 64-bit hash of each word, or of its first ``most`` bytes."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        if most:
            lengths = np.minimum(lengths, most)
        powers = np.cumprod(np.full(int(lengths.max()) + 1, _ODD, np.uint64))
        where = np.repeat(self.starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
        at = np.arange(len(where)) + where
        place = at - np.repeat(self.starts, lengths)
        terms = (self.data[at].astype(np.uint64) + np.uint64(1)) * powers[place]
        begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        return mix(np.add.reduceat(terms, begins) + lengths.astype(np.uint64))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` values, by joining runs of powers of two."""
    total, out, power, run, covered = len(h) - n + 1, None, 1, h, 0
    if total <= 0:
        return np.zeros(0, np.uint64)
    while power <= n:
        if n & power:
            part = run[covered : covered + total]
            out = part if out is None else mix(out * _ODD + part)
            covered += power
        run = mix(run[: len(run) - power] * _ODD + run[power:]) if len(run) > power else run[:0]
        power *= 2
    return mix(out + np.uint64(n))


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every run of ``width``, a power of two."""
    step = 1
    while step < width:
        values = best(values[:-step], values[step:])
        step *= 2
    return values
