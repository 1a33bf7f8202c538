"""Collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from pressgauge.llm import phrases
from pressgauge.session import ship_package


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def plain(rows, support, most, covered, top):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, most + 1):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    found = {p: a for p, a in counts.items() if a >= support and len(p) > 2}
    out = {}
    for (lang, *words), a in found.items():
        holds = lambda q: any(list(q[i : i + len(words)]) == words for i in range(len(q)))
        if any(q[0] == lang and len(q) > len(words) + 1 and holds(q[1:]) and 100 * b >= covered * a for q, b in found.items()):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return {
        (lang, n, p.decode(), -a, x, y, totals[lang], -s)
        for lang, some in out.items()
        for n, (s, a, p, x, y) in enumerate(sorted(some)[:top], 1)
    }


def sample(seed, n=160):
    rng = random.Random(seed)
    words = ["the", "The", "new", "York", "times", "é", "ÉT", "a b", "x", "of", "<>", "日本"]
    gaps = [" "] * 12 + ["  ", "\t", " \t ", ". ", ",", "\n", "\r\n", "? "]
    rows = []
    for i in range(n):
        parts = rng.choices(words, weights=[9, 3, 6, 6, 4, 2, 1, 1, 1, 4, 1, 1], k=rng.randint(0, 40))
        rows.append((i, "".join(w + rng.choice(gaps) for w in parts), rng.choice(["en", "fr", None, "", "und"])))
    rows += [(1, None, "en"), (2, "", None), (3, " \t\n.", "xx"), (None, "new york times " * 30, None), (None, None, None)]
    return rows + [rows[5]] * 40


@pytest.mark.parametrize(
    ("seed", "support", "most", "covered", "top", "bits", "shards"),
    [(1, 10, 3, 50, 2000, 26, None), (2, 4, 3, 80, 7, 26, 3), (3, 3, 4, 30, 50, 7, 2), (4, 1, 2, 50, 2000, 26, None), (5, 12, 3, 50, 2000, 12, 5)],
)
def test_collocations(spark, seed, support, most, covered, top, bits, shards):
    rows = sample(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    found = phrases.collocations(docs, support, 2, most, covered, top, filter_bits=bits, shards=shards)
    got = [(r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, support, most, covered, top) and got


def test_tasks_hand_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "TASK_ENTRIES", 40)
    monkeypatch.setattr(phrases, "HELD_PHRASES", 10)
    monkeypatch.setattr(phrases, "pieces", lambda texts: ((i, i + 1) for i in range(len(texts))))
    rows = sample(6, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    got = {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in phrases.collocations(docs, 5).collect()}
    assert got == plain(rows, 5, 3, 50, 2000)


def test_long_text_extra_columns_and_empty(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    docs = spark.createDataFrame(
        [(1, long, "en", 1, 2, "x", "y", 0), (2, "ab cd " * 20, "en", 1, 2, "x", "y", 0)],
        "doc_id long, text string, lang string, n long, need long, shard string, phrase string, rank int",
    )
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    got = {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in phrases.collocations(docs).collect()}
    assert got == plain(rows, 10, 3, 50, 2000)
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_exact_beyond_64_bits(spark):
    """Products of counts far above 2^63 keep their floor."""
    a, left, right = 3 * 10**9 + 7, 3 * 10**9 + 11, 10**10 + 1
    score = spark.range(1).selectExpr(f"{a}L a", f"{left}L l", f"{right}L r").selectExpr(
        "(cast(1000000 as decimal(8,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) s"
    ).first()["s"]
    assert score == 1_000_000 * a * a // (left * right)


def test_packed_arrays_come_back():
    rng = np.random.default_rng(1)
    for n in (1, 7, 5000):
        keys = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64) >> np.uint64(rng.integers(0, 3)))
        counts = rng.integers(1, 1 << 40, len(keys))
        back = phrases._unpacked(phrases._packed(keys, counts), len(keys))
        assert (back[0] == keys).all() and (back[1] == counts).all()
