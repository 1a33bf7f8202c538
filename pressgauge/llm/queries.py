"""The registered queries of the operators, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.llm import (
    centroids, ctph, mixing, packing, perplexity, phrases, quality, simhash, substring, subwords, tokens, toxicity, warc,
)
from pressgauge.operators.skew import skewed_join
from pressgauge.session import cut_lineage, scratch_dir, ship_package

MAX_TOKENS = 2048


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return planned.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.remove_repeated(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    line = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(line, 256).alias("kept_sha256"))


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokens.token_counts(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op6_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    codec = subwords.Codec.fit(docs, _tokenizer("piece_bpe_32k.model"))
    return codec.round_trips(docs).withColumn("n_tokens", F.size("ids").cast("bigint"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))
    good = (F.col("score") >= quality.THRESHOLD).cast("int")
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", good.alias("predicted"))


def op8_piecewise(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = ctph.edited_fingerprints(_table(spark, sf_dir, "documents"))
    own = F.col("fingerprint")
    return prints.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        ctph.likeness(own, F.col("edited_fingerprint")).alias("near_edited"),
        ctph.likeness(own, F.col("next_fingerprint")).alias("near_next"),
    )


def op9_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality_rules(_table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    records = warc.read_records(spark, path)
    # Only the metadata's block is needed besides the headers.
    block = F.when(F.col("type") == "metadata", F.col("payload").cast("string")).alias("block")
    narrow = cut_lineage(
        records.select("type", "record_id", "concurrent_to", "refers_to", "payload_digest", "payload_bytes", block), "records"
    )
    whole = warc.captures(narrow).select(
        "record_id", "response",
        F.regexp_extract(F.col("metadata")[0]["block"], r"page-id: (-?\d+)", 1).try_cast("bigint").alias("page_id"),
    )
    pages = cut_lineage(whole, "captures")
    is_response = F.col("response.type") == "response"
    known = pages.filter(is_response).select(F.col("record_id").alias("_id"), F.col("page_id").alias("refers_to")).distinct()
    # Only revisits are joined: the responses, which refer to nothing, would all meet in one task.
    revisits = pages.filter(~is_response).withColumn("_id", F.col("response.refers_to"))
    named = skewed_join(revisits, known, "_id", max_hot=warc.HOT_KEYS).select("page_id", "response", "refers_to")
    nothing = pages.filter(is_response).select("page_id", "response", F.lit(None).cast(known.schema["refers_to"].dataType).alias("refers_to"))
    return named.unionByName(nothing).select(
        "page_id", "response.payload_bytes", "response.payload_digest",
        F.col("response.type").alias("record_type"), "refers_to",
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), MAX_TOKENS)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters_with_inertia(_table(spark, sf_dir, "embeddings")).drop("compared")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_mixing, op3_substring, op4_tokens, op5_toxicity,
        op6_subwords, op7_quality, op8_piecewise, op9_perplexity, op10_warc,
        op11_packing, op12_centroids, op13_phrases,
    )
}

_MIXING = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
    sum(source_size) OVER () AS total FROM s
), o AS (
  SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, source) AS k FROM w
), c AS (
  SELECT *, coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM o
), f AS (
  SELECT CAST(total - capped AS DOUBLE) / CAST(free AS DOUBLE) AS level FROM c
  WHERE CAST(total - capped AS DOUBLE) / CAST(free AS DOUBLE) * weight <= 3 * source_size ORDER BY k LIMIT 1
), t AS (
  SELECT source, source_size, CASE WHEN weight * level > 3 * source_size THEN CAST(3 * source_size AS DOUBLE) ELSE level * weight END AS target
  FROM o, f
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 1.0 END AS rate,
    CAST(('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13)) AS BIGINT) / 4503599627370496.0 AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r
"""

_SUBSTRING = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), p AS (
  SELECT doc_id, unnest(range(1, len(words) - 48)) AS i, words FROM d WHERE len(words) >= 50
), h AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS h FROM p
), m AS (
  SELECT h, min(doc_id) AS least FROM h GROUP BY h HAVING min(doc_id) < max(doc_id)
), g AS (
  SELECT DISTINCT doc_id, i + j AS at FROM (SELECT doc_id, i FROM h JOIN m USING (h) WHERE least < doc_id), range(0, 50) AS r(j)
), w AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS at FROM d
), k AS (
  SELECT w.doc_id, count(*) AS n_words, count(g.at) AS n_removed,
    string_agg(CASE WHEN g.at IS NULL THEN word END, ' ' ORDER BY w.at) AS kept
  FROM w LEFT JOIN g ON w.doc_id = g.doc_id AND w.at = g.at GROUP BY w.doc_id
)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

_WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), b AS (
  SELECT page_id, html, array_to_string(list_transform(range(1, 41), lambda i: substr(
    '0000000100100011010001010110011110001001101010111100110111101111', 4 * CAST(strpos('0123456789abcdef', substr(h, i, 1)) AS INT) - 3, 4)), '') AS bits
  FROM p
), g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM b)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
    16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT)
    + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT) + CAST(substr(bits, 5 * i + 5, 1) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to
FROM g
"""



def _centroids_sql(rounds: int = centroids.ROUNDS, k: int = centroids.CENTROIDS) -> str:
    """One assignment and one move per round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (
  SELECT v.row, min(list_sum(list_transform(range(1, {centroids.DIM + 1}), lambda j: (v.e[j] - c.e[j]) * (v.e[j] - c.e[j]))) * {k} + c.c) AS best
  FROM v, c{i} c GROUP BY v.row
)""")
        if i < rounds:
            steps.append(f"""m{i} AS (
  SELECT best % {k} AS c, unnest(range(1, {centroids.DIM + 1})) AS j, unnest(e) AS x FROM a{i} JOIN v USING (row)
), f{i} AS (
  SELECT c, j, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM m{i} GROUP BY c, j
), c{i + 1} AS (
  SELECT o.c, coalesce(g.e, o.e) AS e FROM c{i} o LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS e FROM f{i} GROUP BY c
  ) g ON o.c = g.c
)""")
    return f"""
WITH w AS (
  SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = {centroids.DIM}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), embedding) AS row, vec_id,
    list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM w
), c0 AS (SELECT row - 1 AS c, e FROM v WHERE row <= {k}), {", ".join(steps)}, r AS (
  SELECT vec_id, CAST(best % {k} AS INT) AS cluster, CAST(best // {k} AS BIGINT) AS distance FROM a{rounds} JOIN v USING (row)
)
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM r JOIN c{rounds} c ON r.cluster = c.c
"""


_PHRASES = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM t
), g AS (
  SELECT lang, k, list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' ')) AS found
  FROM w, (VALUES (1), (2), (3)) AS s(k) WHERE len(words) >= k
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, unnest(found) AS phrase FROM g) GROUP BY lang, k, phrase
), n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1 AND f >= 10
), x AS (
  SELECT c.lang, c.phrase, c.a, j, p.f AS l, q.f AS r, CAST(1000000 * CAST(c.a AS HUGEINT) * c.a // (CAST(p.f AS HUGEINT) * q.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f p ON p.lang = c.lang AND p.k = c.j AND p.phrase = array_to_string(c.words[1:c.j], ' ')
  JOIN f q ON q.lang = c.lang AND q.k = c.k - c.j AND q.phrase = array_to_string(c.words[c.j + 1:], ' ')
), b AS (
  SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), h AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase FROM c WHERE k = 3
  ) GROUP BY lang, phrase
), o AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM b LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN n ON n.lang = o.lang WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op2_mixing": _MIXING, "op3_substring": _SUBSTRING, "op10_warc": _WARC, "op12_centroids": _centroids_sql(), "op13_phrases": _PHRASES,
}
