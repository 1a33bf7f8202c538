"""Queries that SQL cannot express against plain Python, written from the operators' descriptions."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pressgauge.llm import ctph, perplexity, quality, queries, toxicity
from pressgauge.session import ship_package

MASK = (1 << 64) - 1
ODD = 0x9E3779B97F4A7C15
SPACES = b"\t\n\x0b\x0c\r "


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()


def mixed(h):
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & MASK
    return h ^ (h >> 31)


# --- op8 ---


def plain_signature(text):
    """Block level and two signatures, byte by byte."""
    data, rolled = bytes(7) + text, []
    for i in range(7, len(data)):
        h = data[i] + sum(data[i - back] * pow(0x100000001B3, back + 1, 1 << 64) for back in range(1, 7))
        rolled.append(mixed(h & MASK))
    level = [min(40, (r & -r).bit_length() - 1 if r else 40) for r in rolled]
    k = 2
    while sum(x >= k for x in level) >= 64:
        k += 1
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    found = []
    for least in (k, k + 1):
        signature, total = "", 0
        for i, r in enumerate(rolled):
            total = (total + r) & MASK
            if level[i] >= least or i == len(rolled) - 1:
                signature += letters[mixed(total) >> 58]
                total = 0
        found.append(signature)
    return k, *found


def edits(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, line[0] = line[0], i
        for j, y in enumerate(b, 1):
            before, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, before + (x != y))
    return line[-1]


def plain_likeness(a, b):
    alike = lambda x, y: 1 - edits(x, y) / max(len(x), len(y)) if x or y else 0.0
    if a == b:
        return 1.0
    if a[0] == b[0]:
        return max(alike(a[1], b[1]), alike(a[2], b[2]))
    if a[0] == b[0] + 1:
        return alike(a[1], b[2])
    return alike(a[2], b[1]) if a[0] + 1 == b[0] else 0.0


def test_piecewise_query(spark, sf_dir, rows):
    texts = {r["doc_id"]: r["text"] or "" for r in rows}
    order = sorted(texts)
    prints = {i: plain_signature(t.encode()) for i, t in texts.items() if len(t) < 6_000}
    got = {r["doc_id"]: r for r in queries.op8_piecewise(spark, sf_dir).collect()}
    assert set(got) == set(texts) and len(prints) > 100
    shown = lambda p: f"{p[0]}:{p[1]}:{p[2]}"
    for at, i in enumerate(order):
        following = order[(at + 1) % len(order)]
        if i not in prints or following not in prints:
            continue
        n, r = len(texts[i]), got[i]
        edited = texts[i][: n - n // 4] + texts[following][: n // 4]
        changed = plain_signature(edited.encode())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (shown(prints[i]), shown(changed))
        assert r["near_edited"] == pytest.approx(plain_likeness(prints[i], changed))
        assert r["near_next"] == pytest.approx(plain_likeness(prints[i], prints[following]))
    assert ctph.fingerprints_of([b"", b"a"]) == [shown(plain_signature(b"")), shown(plain_signature(b"a"))]


def test_piecewise_with_a_hot_id(spark, tmp_path):
    """A third of the rows without id and a third with one id: each has the row behind it as its next."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i} " * (1 + i % 5)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op8_piecewise(spark, str(tmp_path)).collect()
    order = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0], r[1]))
    want = Counter()
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        n = len(text)
        edited = text[: n - n // 4] + after[: n // 4]
        want[i, n, hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want


# --- op5 ---


def plain_hash(word):
    total = sum((b + 1) * pow(ODD, i + 1, 1 << 64) for i, b in enumerate(word))
    return mixed((total + len(word)) & MASK)


def plain_features(text):
    lower = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in text)
    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", lower)
    found = {plain_hash(w) for w in words}
    return found | {mixed((plain_hash(w[:n]) + n) & MASK) for w in words for n in (4, 5, 6) if len(w) > n}


def test_toxicity_query(spark, sf_dir, rows):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    chain = toxicity.fit(docs, labels)
    weights = [dict(zip(x.features.tolist(), x.weights.tolist())) for x in chain.links]
    assert any(weights)
    got = {r["doc_id"]: r for r in queries.op5_toxicity(spark, sf_dir).collect()}
    for r in rows:
        have, before = plain_features((r["text"] or "").encode()), []
        for link, known in zip(chain.links, weights):
            z = sum(known[f] for f in have if f in known) + sum(p * w for p, w in zip(before, link.earlier)) + link.bias
            before.append(1 / (1 + math.exp(-max(-40, min(40, z)))))
        mine = got[r["doc_id"]]
        assert [mine[f"p_{name}"] for name in chain.names] == pytest.approx(before, abs=1e-6)
        assert mine["rejected"] == int(mine["p_toxic"] >= 0.5)


def test_toxicity_on_held_out_rows(spark):
    """Fitted on four fifths of the labels, judged on the rest."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    kept, apart = "crc32(cast(doc_id AS string)) % 5 != 0", "crc32(cast(doc_id AS string)) % 5 = 0"
    chain = toxicity.fit(docs, labels.filter(kept))
    judged = toxicity.score(docs, chain).join(labels.filter(apart), "doc_id").select("rejected", "toxic").collect()
    clean = [r["rejected"] for r in judged if not r["toxic"]]
    assert len(clean) > 50 and np.mean(clean) < 0.05
    assert np.mean([r["rejected"] == r["toxic"] for r in judged]) > 0.93


# --- op7 ---


def plain_quality_features(text):
    words = text.split()
    n, some, size = len(words), max(1, len(words)), max(1, len(text))
    chars = lambda wanted: sum(b in wanted for b in text) / size
    share = lambda marks: sum(marks) / some
    counts = Counter(words)
    five = Counter(tuple(words[i : i + 5]) for i in range(n - 4))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    symbols = b"#*$%&|<>@^~=_+\\/{}[]"
    upper = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return [
        math.log1p(n), sum(map(len, words)) / some, chars(upper), chars(b"0123456789"), chars(symbols), chars(b".?!"), chars(b",;:'\"()-"),
        sum(b >= 128 for b in text) / size, len(counts) / some, max(counts.values(), default=0) / some,
        sum(c for c in five.values() if c > 1) / some, share(a == b for a, b in zip(words, words[1:])),
        n / max(1, len(lines)), (len(lines) - len(set(lines))) / max(1, len(lines)),
        share(len(w) <= 3 for w in words), share(len(w) >= 12 for w in words), share(w[-1] in symbols for w in words),
        share(w[0] in upper for w in words), chars(b"|"), chars(b"!"),
    ]


def test_quality_query(spark, sf_dir, rows):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    got = {r["doc_id"]: r for r in queries.op7_quality(spark, sf_dir).collect()}
    assert len(model.pairs) and len(got) == len(rows)
    for r in rows:
        x = plain_quality_features((r["text"] or "").encode())
        place = lambda edges, v: sum(e <= v for e in edges)
        z = model.bias + sum(t[place(e, v)] for t, e, v in zip(model.tables, model.edges, x))
        z += sum(t[place(model.coarse[i], x[i]), place(model.coarse[j], x[j])] for i, j, t in model.pairs)
        mine = got[r["doc_id"]]
        assert mine["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-6)
        assert mine["predicted"] == int(mine["score"] >= 0.3)


# --- op9 ---


def plain_symbols(text):
    def one(b):
        c = chr(b)
        if b >= 128:
            return 36 + (b & 0x1F) % 28
        if c.islower():
            return 2 + b - ord("a")
        if c.isupper():
            return 28
        if c.isdigit():
            return 29
        return {" ": 1, ".": 30, ",": 31, "!": 32, "?": 32}.get(c, 33 if c in "#*$%&|<>@^~=_+\\/{}[]" else 34)

    return [0, 0, 0, *map(one, b" ".join(text.encode().split()).replace(b"\0", b"\1")), 0]


def plain_kneser_ney(windows):
    """Probability of every counted 4-gram by interpolated modified Kneser-Ney."""
    tables = {4: windows}
    for k in (3, 2, 1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    below = None
    for k in (1, 2, 3, 4):
        table = tables[k]
        n = [sum(v == i for v in table.values()) for i in range(5)]
        discount = {}
        for i in (1, 2, 3):
            y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
            d = i - (i + 1) * y * n[i + 1] / n[i] if y is not None and n[i] and i < 4 else None
            discount[i] = d if d is not None and 0 < d < i else i / 2
        whole, cut = defaultdict(float), defaultdict(float)
        off = {g: min(discount[min(v, 3)], v) for g, v in table.items()}
        for g, v in table.items():
            whole[g[:-1]] += v
            cut[g[:-1]] += off[g]
        below = {
            g: (v - off[g]) / whole[g[:-1]] + cut[g[:-1]] / whole[g[:-1]] * (1 / 64 if k == 1 else below[g[1:]]) for g, v in table.items()
        }
    return below


def test_perplexity_query(spark, sf_dir, rows):
    by_lang = defaultdict(list)
    for r in rows:
        s = plain_symbols(r["text"] or "")
        by_lang[r["lang"]].append((r["doc_id"], [tuple(s[i : i + 4]) for i in range(len(s) - 3)]))
    got = {r["doc_id"]: r for r in queries.op9_perplexity(spark, sf_dir).collect()}
    for texts in by_lang.values():
        p = plain_kneser_ney(Counter(w for _, some in texts for w in some))
        mine = {i: -sum(math.log(p[w]) for w in some) / len(some) for i, some in texts}
        assert {i: got[i]["log_ppl"] for i in mine} == pytest.approx(mine, rel=1e-4)
        good = sorted(got[i]["log_ppl"] for i in mine if not got[i]["base_failed"])
        if not good:
            continue
        low, high = (good[max(0, math.ceil(q * len(good)) - 1)] for q in (0.25, 0.75))
        wide = perplexity.FENCE * (high - low)
        for i in mine:
            inside = low - wide <= got[i]["log_ppl"] <= high + wide
            assert got[i]["kept"] == (not got[i]["base_failed"] and inside)
