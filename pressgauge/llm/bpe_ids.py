"""Token ids of whole texts by a lower-casing word BPE, with every part of a word encoded once per worker.

White space ends every token, and inside a word the tokenizer's pattern cuts letters, single digits, other signs and a
few endings with an apostrophe into parts that never merge. So texts are cut into parts by numpy over bytes, distinct
parts are looked up in the worker's table, and the library encodes the new ones. Parts are told apart by a 64-bit
hash that has their length in it.
"""

from __future__ import annotations

import numpy as np

from pressgauge.llm.scan import LOWER, SPACE, mix
from pressgauge.llm.scan import pieces as text_groups

# The pattern by which the tokenizer cuts lower-cased text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
WORD_END = "</w>"
#: A worker forgets its parts beyond this many parts or ids and starts anew.
TABLE_PARTS = 600_000
TABLE_IDS = 6_000_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.uint64(0xD6E8FEB86659FD93)
_LETTER, _DIGIT, _SIGN, _OTHER = 1, 2, 3, 4
_CLASS = np.full(256, _OTHER, np.int8)
_CLASS[0x21:0x7F] = _SIGN
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x61:0x7B] = _LETTER
_CLASS[SPACE] = 0


class Parts:
    """Parts of several texts: offsets into ``data`` (lower-cased but for odd words) and the first part of each text.

    A word with anything beyond ASCII signs and Latin-1 letters, or with the beginning of a special string, is odd: it is one
    part with its own bytes, for the library to cut.
    """

    def __init__(self, texts: list[bytes], cut: bool = True):
        raw = np.frombuffer(b" ".join(texts) + b"   ", np.uint8)
        data = LOWER[raw]
        kind = _CLASS[data]
        if not cut:
            kind[kind > 0] = _OTHER
        # Latin-1 letters are two bytes; their upper case lies 32 below.
        lead = np.flatnonzero(raw[:-1] == 0xC3)
        second = raw[lead + 1]
        letter = (second != 0x97) & (second != 0xB7) & (second >= 0x80)
        lead, second = lead[letter], second[letter]
        upper = lead[second <= 0x9E] + 1
        data[upper] += 0x20
        if cut:
            kind[lead] = kind[lead + 1] = _LETTER
        kind[np.flatnonzero((raw[:-1] == 0x3C) & (raw[1:] == 0x7C))] = _OTHER
        inside = kind > 0
        word_start = np.flatnonzero(inside[:-1] & ~np.concatenate(([False], inside[:-2])))
        word_end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        # A part begins where the kind changes, and at every digit.
        begins = np.empty(len(kind), bool)
        begins[0] = inside[0]
        begins[1:] = inside[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
        for at in np.flatnonzero((data[:-3] == 0x27) & begins[:-3] & (kind[1:-2] == _LETTER)).tolist():
            for ending in ENDINGS:
                stop = at + 1 + len(ending)
                if data[at + 1 : stop].tobytes() == ending:
                    begins[at + 1] = False
                    if kind[stop] == _LETTER:
                        begins[stop] = True
                    break
        strange = np.flatnonzero(kind == _OTHER)
        odd_words = np.unique(np.searchsorted(word_start, strange, "right") - 1)
        for w in odd_words.tolist():
            a, b = word_start[w], word_end[w]
            begins[a + 1 : b] = False
            data[a:b] = raw[a:b]
        self.data, self.starts = data, np.flatnonzero(begins)
        # A part ends where the next begins or its word ends.
        following = np.concatenate((self.starts[1:], [len(kind)]))
        self.ends = np.minimum(following, word_end[np.searchsorted(word_start, self.starts, "right") - 1]) if len(self.starts) else self.starts
        self.odd = np.zeros(len(self.starts), bool)
        self.odd[np.searchsorted(self.starts, word_start[odd_words])] = True
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.first = np.searchsorted(self.starts, np.concatenate(([0], np.cumsum(sizes))))

    def hashes(self) -> np.ndarray:
        lengths = self.ends - self.starts
        if not len(lengths):
            return np.zeros(0, np.uint64)
        powers = np.cumprod(np.full(int(lengths.max()) + 1, _ODD, np.uint64))
        begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        place = np.arange(int(lengths.sum())) - np.repeat(begins, lengths)
        values = self.data[place + np.repeat(self.starts, lengths)].astype(np.uint64) + np.uint64(1)
        terms = np.add.reduceat(mix(values * powers[place]), begins)
        return mix(terms + lengths.astype(np.uint64) + np.where(self.odd, _SALT, np.uint64(0)))


class Encoder:
    """Ids of texts as arrays, equal to the library's without added special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole, self.parts = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for tokenizer in (self.whole, self.parts):
            tokenizer.no_truncation()
            tokenizer.no_padding()
        #: Another tokenizer's words are not cut.
        self.cut = PATTERN in str(self.whole.pre_tokenizer)
        self.parts.normalizer = None
        self.parts.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        vocabulary = self.whole.get_vocab()
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.last[[i for piece, i in vocabulary.items() if piece.endswith(WORD_END)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.begin, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.pool, self.used = np.zeros(1 << 14, "<u4"), 0

    def _keep(self, hashes: list[int], sizes: np.ndarray, ids: np.ndarray) -> None:
        n, m = len(self.known), len(hashes)
        while n + m > len(self.begin):
            self.begin, self.size = (np.concatenate((x, np.zeros_like(x))) for x in (self.begin, self.size))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        self.begin[n : n + m] = self.used + np.cumsum(sizes) - sizes
        self.size[n : n + m] = sizes
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.known.update(zip(hashes, range(n, n + m)))

    def _learn(self, parts: Parts, hashes: np.ndarray, at: np.ndarray) -> None:
        """Encode the parts numbered ``at``; the last id of a part that is not odd is one that ends a word, and no other is."""
        data = parts.data.tobytes()
        odd = parts.odd[at]
        for some in np.array_split(at[~odd], max(1, -(-int((~odd).sum()) // 512))):
            if len(some):
                texts = [data[a:b].decode() for a, b in zip(parts.starts[some].tolist(), parts.ends[some].tolist())]
                coded = self.parts.encode_batch_fast([texts], is_pretokenized=True, add_special_tokens=False)[0]
                ids = np.array(coded.ids, "<u4")
                ends = np.flatnonzero(self.last[ids]) + 1
                self._keep(hashes[some].tolist(), np.diff(ends, prepend=0), ids)
        some = at[odd]
        if len(some):
            texts = [data[a:b].decode() for a, b in zip(parts.starts[some].tolist(), parts.ends[some].tolist())]
            coded = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
            sizes = np.fromiter(map(len, coded), np.int64, len(coded))
            self._keep(hashes[some].tolist(), sizes, np.array([i for ids in coded for i in ids], "<u4"))

    def _group(self, texts: list[bytes]) -> list[np.ndarray]:
        parts = Parts(texts, self.cut)
        hashes = parts.hashes()
        kinds, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(kinds) > TABLE_PARTS or self.used > TABLE_IDS:
            self._forget()
        found = list(map(self.known.get, kinds.tolist()))
        new = np.array([i for i, n in enumerate(found) if n is None], np.int64)
        if len(new):
            self._learn(parts, hashes, where[new])
            found = list(map(self.known.__getitem__, kinds.tolist()))
        entry = np.array(found, np.int64)[inverse]
        sizes = self.size[entry]
        ends = np.cumsum(sizes)
        at = np.arange(int(sizes.sum())) + np.repeat(self.begin[entry] - (ends - sizes), sizes)
        ids = self.pool[at]
        edges = np.concatenate(([0], ends))[parts.first].tolist()
        return [ids[a:b] for a, b in zip(edges, edges[1:])]

    def encode(self, texts: list[bytes]):
        """The ids of each text, in order."""
        for a, b in text_groups(texts):
            yield from self._group(texts[a:b])
