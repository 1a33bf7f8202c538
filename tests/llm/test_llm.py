"""The operators against brute force, libraries and SQL, on the smallest tables and on hand-made rows."""

import base64
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from pressgauge.llm import (
    ctph, links, mixing, perplexity, quality, queries, simhash, substring, subwords, tokens, toxicity, warc,
)
from pressgauge.session import scratch_dir, ship_package

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
ODD = [None, "", " \t\n", "a", "one two three", "one two three", "é ü ß 你好 🙂", "x" * 500, LONG, LONG + " end"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and columns with clashing names."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", 1, 2, 3, "x") for i, t in enumerate(ODD)]
    rows += [rows[4], (None, "no id", None, None, None, None, None, None), (3, "again three", "en", "s", 1, 2, 3, "y")]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, n_words bigint, fp string"
    )


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def test_queries_with_sql(spark, sf_dir):
    con = duckdb.connect()
    for name in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    for name, sql in queries.ORACLE.items():
        result = con.execute(sql)
        columns = [d[0] for d in result.description]
        got = queries.REGISTRY[name](spark, sf_dir)
        assert sorted(columns) == sorted(got.columns), name
        assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(result.fetchall()), name


def plain_fingerprint(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id per id, over all pairs."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in prints}


def test_simhash(spark, sf_dir, texts):
    got = queries.op1_simhash(spark, sf_dir).collect()
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in got} == plain_components(prints)


def test_near_pairs_lose_no_link(spark):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1}
    for p in list(prints):
        for flips in (1, 2, 3, 4, 4, 4, 5):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), flips)))
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    pairs = simhash.near_pairs(spark.createDataFrame(signed, "fp bigint")).collect()
    got = {frozenset((r["a"] % 2**64, r["b"] % 2**64)) for r in pairs}
    assert got == {frozenset(x) for x in itertools.combinations(prints, 2) if (x[0] ^ x[1]).bit_count() <= 4}


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r["node"]: r["root"] for r in links.components(spark.createDataFrame(chain, "a bigint, b bigint"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_simhash_odd_rows(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    zero = [r for r in got if r["doc_id"] in (0, 1, 2)]
    assert {(r["fingerprint"], r["component_id"]) for r in zero} == {("0" * 16, 0)}
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 4 in ids and 5 not in ids and None in ids
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_first(none).count() == 0


def test_mixing_targets(spark):
    sizes = spark.createDataFrame([("a", 1, 10), ("b", 1, 1000), (None, 1, 490), ("c", 1, 0)], "source string, n long, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    # a stops at 30, c at 0; 1470 words are left for b (2) and the null source (5).
    assert got == {"a": 30.0, "b": pytest.approx(420.0), "c": 0.0, None: pytest.approx(1050.0)}


def test_mixing_comes_near_and_repeats(spark):
    rows = [(i, "s%d" % (i % 3), "w " * (1 + i % 7)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    planned = mixing.plan(docs).collect()
    taken = defaultdict(int)
    for r in planned:
        taken[r["source"], r["target"]] += r["size"] * r["copies"]
        assert r["copies"] <= 3
    assert all(abs(t / target - 1) < 0.05 for (_, target), t in taken.items())
    mixed = Counter(r["doc_id"] for r in mixing.mix(docs).collect())
    assert mixed == Counter({r["doc_id"]: r["copies"] for r in planned if r["copies"]})


def test_mixing_odd_rows(odd, none):
    assert mixing.plan(odd).count() == odd.count()
    assert mixing.mix(odd).columns == odd.columns and mixing.mix(none).count() == 0


def plain_removal(docs, window):
    least = {}
    for i, words in docs:
        for j in range(len(words) - window + 1):
            key = tuple(words[j : j + window])
            least[key] = min(i, least.get(key, i))
    out = []
    for i, words in docs:
        gone = set()
        for j in range(len(words) - window + 1):
            if least[tuple(words[j : j + window])] < i:
                gone |= set(range(j, j + window))
        out.append((i, len(words), len(gone), tuple(w for k, w in enumerate(words) if k not in gone)))
    return Counter(out)


@pytest.mark.parametrize("limit", [200_000, 3])
def test_substring_random(spark, monkeypatch, limit):
    rng = random.Random(3)
    docs = []
    for i in range(150):
        words = [rng.choice("abcdefghijk") for _ in range(rng.randint(0, 60))]
        if docs and i % 2:
            source = rng.choice(docs)[1]
            cut = rng.randint(0, max(0, len(source) - 1))
            words[len(words) // 2 : len(words) // 2] = source[cut : cut + 30]
        docs.append((i // 2 * 2 if i % 10 == 0 else i, words))
    monkeypatch.setattr(substring, "SHARE", 4)
    monkeypatch.setattr(substring, "MAX_AUTOMATON_WORDS", limit)
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    got = substring.remove_repeated(df, 5).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], tuple(r["text"].split())) for r in got) == plain_removal(docs, 5)


def test_automaton_statistics():
    rng = random.Random(1)
    passages = [[rng.choice("abc") for _ in range(rng.randint(1, 25))] for _ in range(6)]
    automaton = substring.Automaton()
    for p in passages:
        automaton.add(p)
    known = {tuple(p[a:b]) for p in passages for a in range(len(p)) for b in range(a + 1, len(p) + 1)}
    words = [rng.choice("abcd") for _ in range(300)]
    want = [max(n for n in range(0, i + 2) if not n or tuple(words[i + 1 - n : i + 1]) in known) for i in range(len(words))]
    assert automaton.statistics(words) == want


def test_substring_odd_rows(odd, none):
    got = substring.remove_repeated(odd).collect()
    assert len(got) == odd.count()
    long = {r["doc_id"]: r for r in got if r["doc_id"] in (8, 9)}
    assert long[8]["n_removed"] == 0 and long[9]["text"] == "end"
    assert [r["text"] for r in got if r["doc_id"] == 0] == [None]
    assert substring.remove_repeated(none).count() == 0


def test_tokens(spark, sf_dir, texts, odd, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    count = lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids)
    got = queries.op4_tokens(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in got} == {i: (len(t.encode()), count(t)) for i, t in texts.items()}
    strange = ["<|endoftext|>a<|startoftext|> b", "Σίσυφος ΟΔΟΣ don'T x\x1cy", "é ́", "a　b\x85c", "﻿q ½²"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(strange)], "doc_id long, text string")
    assert [r["n_tokens"] for r in sorted(tokens.token_counts(df, BPE).collect())] == [count(t) for t in strange]
    rows = tokens.token_counts(odd, BPE).collect()
    assert Counter(r["n_tokens"] for r in rows) == Counter(count(r["text"]) for r in odd.collect())
    assert tokens.token_counts(none, BPE).count() == 0


def test_toxicity(spark):
    rng = random.Random(2)
    bad = ["nasty", "vileness", "grimly"]
    rows, marks = [], []
    for i in range(600):
        words = [f"word{rng.randint(0, 300)}" for _ in range(rng.randint(5, 60))]
        if i % 5 == 0:
            words.insert(rng.randint(0, len(words)), rng.choice(bad).upper() + ",")
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 7 != 0), int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks[:400], "doc_id long, quality int, toxic int")
    chain = toxicity.fit(docs, labels)
    assert [len(x.earlier) for x in chain.links] == [0, 1, 2]
    got = {r["doc_id"]: r["rejected"] for r in toxicity.score(docs, chain).collect()}
    assert sum(got[i] != (i % 5 == 0) for i in range(400, 600)) <= 4
    assert {r["doc_id"] for r in toxicity.keep_clean(docs, chain).collect()} == {i for i, r in got.items() if not r}


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        chain = toxicity.fit(odd, known)
        assert toxicity.score(odd, chain).count() == odd.count()
        assert toxicity.score(none, chain).count() == 0
        assert toxicity.keep_clean(odd, chain).columns == odd.columns
    toxicity.fit(none, labels)


def test_subwords_equal_the_library(spark, texts, odd, none):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECES)
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    codec = subwords.Codec.fit(docs, PIECES, most=2000)
    coded = docs.withColumn("ids", codec.encode(F.col("text"))).withColumn("back", codec.decode(F.col("ids")))
    for r in coded.collect():
        assert r["ids"] == model.encode(r["text"] or "") and r["back"] == (r["text"] or "")
    pieces, frequent, _ = codec._shared.value
    assert 200 < len(frequent) <= 2000 and all(pieces.merge(u) == ids for u, ids in frequent.items())
    assert subwords.Codec.fit(none, PIECES).encode(F.col("text")) is not None


def test_viterbi_fold(spark):
    rows = [("ab", 1, -1.0), ("a", 2, -2.0), ("b", 3, -2.5), ("bc", 4, -0.2), ("abc", 5, -4.0), ("c", 6, -1.5), ("▁", 7, -0.5)]
    pieces = subwords.Pieces.of(rows, 1000)
    units = ["".join(u) for n in range(1, 6) for u in itertools.product("abc", repeat=n)] + ["▁ab", "aéb"]
    folded = subwords.fold_viterbi(subwords.lattice(spark.createDataFrame([(u,) for u in units], "unit string"), pieces), 1000)
    got = {r["unit"]: r["ids"] for r in folded.collect()}
    score = {i: s for _, i, s in rows}

    def best(unit):
        if not unit:
            return 0.0
        heads = [(s, p) for p, s in pieces.scores.items() if unit.startswith(p)] or [(subwords.UNKNOWN, unit[0])]
        return max(s + best(unit[len(p) :]) for s, p in heads)

    text = {i: p for p, i, _ in rows}
    for u in units[:-1]:
        assert "".join(text[i] for i in got[u]) == u and sum(score[i] for i in got[u]) == pytest.approx(best(u))
    assert got["aéb"] == [2, 1000 + 0xC3, 1000 + 0xA9, 3]


def test_quality(spark, sf_dir, texts, odd, none):
    got = {r["doc_id"]: r for r in queries.op7_quality(spark, sf_dir).collect()}
    assert {i: r["held_out"] for i, r in got.items()} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in texts}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    wide = queries.op7_quality(spark, "/root/testdata/sf0.01").filter("held_out").join(labels, "doc_id").collect()
    right = np.mean([r["predicted"] == r["quality"] for r in wide])
    assert right > 0.95
    few = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (5, None)], "doc_id long, quality int")
    for known in (few, few.limit(0)):
        scores = [r["score"] for r in quality.score(odd, quality.fit(odd, known)).collect()]
        assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    assert quality.score(none, quality.fit(none, few)).count() == 0


def test_piecewise(spark, sf_dir, texts, odd, none):
    got = {r["doc_id"]: r for r in queries.op8_piecewise(spark, sf_dir).collect()}
    order = sorted(texts)
    for at, i in enumerate(order):
        text, after = texts[i], texts[order[(at + 1) % len(order)]]
        edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        prints = [ctph.fingerprints_of([t.encode()])[0] for t in (text, edited, after)]
        assert [r["fingerprint"], r["edited_fingerprint"]] == prints[:2]
    assert np.mean([r["near_edited"] for r in got.values()]) > 0.6 > 0.1 > np.mean([r["near_next"] for r in got.values()])
    rows = ctph.edited_fingerprints(odd).collect()
    assert len(rows) == odd.count() and all(r["edited_sha256"] for r in rows)
    assert ctph.edited_fingerprints(none).count() == 0
    alone = ctph.edited_fingerprints(odd.filter("doc_id = 6")).first()
    assert alone["next_fingerprint"] == alone["fingerprint"]


def test_perplexity_base_rules(spark, sf_dir, texts, odd, none):
    def base(text):
        words = WORD.findall(text or "")
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        again = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again)

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = queries.op9_perplexity(spark, sf_dir).collect()
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in got} == {i: base(t) for i, t in texts.items()}
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    rows = perplexity.quality_rules(odd).collect()
    assert Counter(tuple(r[n] for n in names) for r in rows) == Counter(base(r["text"]) for r in odd.collect())
    assert perplexity.quality_rules(none).count() == 0


def test_perplexity_bands_reject_junk(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = queries.op9_perplexity(spark, "/root/testdata/sf0.01").filter("not base_failed").join(labels, "doc_id").collect()
    rejected = {q: [not r["kept"] for r in rows if r["quality"] == q] for q in (0, 1)}
    assert np.mean(rejected[0]) > 0.5 and np.mean(rejected[1]) < 0.1


def test_kneser_ney_sums_to_one(spark, sf_dir):
    """Over all symbols that follow a context, with what the lower orders give the unseen ones."""
    docs = spark.createDataFrame([("en", "abab abba baab"), ("en", "abcabc"), (None, "zz")], "lang string, text string")
    counts = perplexity.count_ngrams(docs)
    assert counts.agg(F.sum("n")).first()[0] == sum(len(t) + 1 for t in ("abab abba baab", "abcabc", "zz"))
    model = perplexity.kneser_ney(counts).withColumn("p", F.exp("logp"))
    sums = model.groupBy("lang", F.shiftright("code", 6)).agg(F.sum("p").alias("s")).collect()
    assert all(0 < r["s"] <= 1.0001 for r in sums)
    assert set(perplexity.hash_arrays(model)) == {"en", None}


def test_warc_round_trip(spark):
    magic = "WARC/1.1\r\nWARC-Type: response\r\n\r\n"
    rows = [(1, "http://a/\r\nX: y", "same"), (5, "u", "same"), (3, None, "same"), (2, "u", ""), (9, "u", None), (7, "u", f"a{magic}b\r\n\r\n{magic}"), (None, "u", "same"), (8, "u", "é\x00\n" * 9000)]
    rows.append(rows[1])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    path = scratch_dir(spark, "warc")
    warc.write_archives(pages, path)
    records = warc.read_records(spark, path)
    got = records.collect()
    assert len(got) == 27 and all(r["complete"] for r in got)
    bodies = Counter(bytes(r["payload"]).decode() for r in got if r["type"] == "response")
    assert bodies == Counter(["same", "same", "same", "", rows[5][2], rows[7][2]])
    again = [r for r in got if r["type"] == "revisit"]
    want = base64.b32encode(hashlib.sha1(b"same").digest()).decode()
    assert len(again) == 3 and {(r["payload_bytes"], r["payload_digest"]) for r in again if r["payload_bytes"]} == {(4, want)}
    made = warc.captures(records.filter("record_id IS NOT NULL").dropDuplicates(["record_id"])).collect()
    assert len(made) == 8 and all(len(r["requests"]) == len(r["metadata"]) == 1 for r in made)
    empty = scratch_dir(spark, "warc")
    warc.write_archives(pages.limit(0), empty)
    assert warc.captures(warc.read_records(spark, empty)).count() == 0


def test_warc_repeated_and_null_ids(spark, tmp_path):
    rows = [(9, "u", "same")] * 3 + [(9, "v", "same"), (9, "u", "other"), (4, "u", "same"), (4, "u", "same"), (5, "w", "same")]
    rows += [(None, f"n{i}", f"null {i}") for i in range(6)] + [(None, "n", "same")] * 2 + [(None, "n", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op10_warc(spark, str(tmp_path)).collect()
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    again = lambda i, t: i in (4, 5) and t == "same"
    want = Counter((i, len(t or ""), digest(t), "revisit" if again(i, t) else "response", 9 if again(i, t) else None) for i, _, t in rows)
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == want
    path = scratch_dir(spark, "warc")
    warc.write_archives(pages, path)
    made = warc.captures(warc.read_records(spark, path)).collect()
    assert len(made) == len(rows) and len({r["record_id"] for r in made}) == len(set(rows))
    assert all(len(r["requests"]) == len(r["metadata"]) == 1 for r in made)


def test_pipeline_drops_planted_near_copies(spark, sf_dir):
    """One row of each group by the fingerprints' bits; rows that share an id are told apart by their texts."""
    rng = random.Random(4)
    rows = []
    for i in range(60):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(600)]
        changed = [w if k % 300 or not i % 3 else f"new{k}" for k, w in enumerate(words)]
        rows += [(i, " ".join(words)), (1000 + i, " ".join(changed))]
    rows += [(5, "no copy of the other row with this id"), (7, rows[14][1]), (None, rows[0][1]), (None, "alone without an id"), (None, "alone without an id")]
    keys = {n: (i is None, i or 0, n) for n, (i, _) in enumerate(rows)}
    root = plain_components({n: plain_fingerprint(t) for n, (_, t) in enumerate(rows)})
    want = Counter()
    for group in set(root.values()):
        first = min((n for n in root if root[n] == group), key=keys.get)
        want[rows[first]] += 1
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir)
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == want


def test_pipeline_stages_on_odd_rows(spark, sf_dir):
    """Nulls in any column, empty and long texts, ties, repeated rows and clashing names, with what each stage makes of them."""
    names = "size long, n_words long, n_removed long, copies string, key string, id string, _id string, ids string, fp string, c0 string"
    extra = (11, 12, 13, "copies", "key", "id", "_id", "ids", "fp", "c0")
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", 7) for i, t in enumerate(ODD)]
    rows += [rows[4], (None, "no id", None, None, None), (3, "again three", "en", "s", 1), (None, LONG, None, "s", None)]
    docs = spark.createDataFrame([r + extra for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {names}")
    plain = lambda df: Counter(tuple(r) for r in df.collect())
    clean, single, cut, mixed, coded = (stage for _, stage in corpus_pipeline.STAGES)
    assert plain(clean(spark, docs, sf_dir)) == plain(docs)
    one = single(spark, docs, sf_dir)
    kept = {(r["doc_id"], r["text"]) for r in one.collect()}
    assert one.columns == docs.columns and one.count() == len(kept)
    assert [x for x in kept if x[0] in (0, 1, 2)] == [(0, None)] and {(3, "a"), (3, "again three"), (None, "no id"), (4, ODD[4])} <= kept
    assert (None, LONG) not in kept and (5, ODD[5]) not in kept and plain(one) <= plain(docs)
    less = cut(spark, docs, sf_dir)
    want = Counter((9, "end", None if 9 % 2 == 0 else "en", "s", 3) + extra if r[0] == 9 else r + extra for r in rows)
    assert less.columns == docs.columns and plain(less) == want
    spread = mixed(spark, docs, sf_dir)
    copies = Counter(r["doc_id"] for r in spread.collect())
    planned = mixing.plan(docs.drop("size", "copies")).collect()
    assert copies == +sum((Counter({r["doc_id"]: r["copies"]}) for r in planned), Counter())
    assert spread.columns == docs.columns and set(plain(spread)) <= set(plain(docs))
    last = coded(spark, docs, sf_dir)
    assert last.columns == [*docs.columns, "ids_1"] and plain(last.select(*docs.columns)) == plain(docs)
    assert {r["doc_id"]: r["ids_1"] for r in last.collect() if r["doc_id"] in (0, 1)} == {0: [], 1: []}


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_dir(spark, "stages")
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], sf_dir).write.parquet(f"{folder}/{k}")
        seen.append(spark.read.parquet(f"{folder}/{k}"))
    assert all(sorted(x.columns) == sorted(docs.columns) for x in seen[1:-1])
    clean, single, cut, mixed, coded = seen[1:]
    assert clean.count() < docs.count() and single.count() < clean.count() == clean.select("doc_id").distinct().count()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in clean.collect()}
    assert {r["doc_id"] for r in single.collect()} == set(plain_components(prints).values())
    want = plain_removal([(r["doc_id"], WORD.findall(r["text"])) for r in single.collect()], 50)
    kept = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert {i: tuple(WORD.findall(t)) for i, t in kept.items()} == {i: words for i, _, _, words in want}
    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert copies == Counter({r["doc_id"]: r["copies"] for r in mixing.plan(cut).collect() if r["copies"]})
    assert Counter(r["doc_id"] for r in coded.collect()) == copies
    for x in seen[:1]:
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, x.limit(0), sf_dir).count() == 0
