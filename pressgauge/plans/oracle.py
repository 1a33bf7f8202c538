"""DuckDB SQL for the registered queries, put together from named common tables.

Fixed values (keywords, stop words, patterns) are shared with the library; the logic is
written a second time, in plain SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pressgauge.functions import stem
from pressgauge.functions.text import ACCENTED, UNACCENTED
from pressgauge.operators.entities import DEFAULT_RULES
from pressgauge.plans import bindings as b

BREAK = r"(?:[^\p{L}\p{N}]|[0-9])+"


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values: Sequence[str]) -> str:
    return ", ".join(q(v) for v in values)


def clean(c: str) -> str:
    flat = f"regexp_replace(regexp_replace({c}, '[\\n\\t]+', ' ', 'g'), '\\s{{2,}}', ' ', 'g')"
    return f"regexp_replace({flat}, '^\\s+|\\s+$', '', 'g')"


def words(c: str, fold: bool = False) -> str:
    low = f"regexp_replace(lower({c}), 'https?://', '', 'g')"
    if fold:
        low = f"translate({low}, {q(ACCENTED)}, {q(UNACCENTED)})"
    return f"list_filter(regexp_split_to_array({low}, {q(BREAK)}), lambda w: w <> '')"


def no_stops(tokens: str) -> str:
    return f"list_filter({tokens}, lambda w: w NOT IN ({listed(b.STOP_WORDS)}))"


def portal(link: str) -> str:
    return f"nullif(regexp_extract({link}, 'www.([\\p{{L}}\\p{{N}}_]+)', 1), '')"


def host(url: str) -> str:
    return f"lower(regexp_extract({url}, '^[A-Za-z]+://([^/?#:@]+)', 1))"


def keyword_values(keywords: Sequence[str]) -> str:
    return ", ".join(f"({i}, {q(k)})" for i, k in enumerate(keywords))


TABLES: dict[str, tuple[Sequence[str], str]] = {}


def define(name: str, needs: Sequence[str], sql: str) -> None:
    TABLES[name] = (needs, sql)


def build(needs: Sequence[str], final: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in TABLES[name][0]:
            visit(other)
        ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return final
    ctes = ",\n".join(f"{name} AS ({TABLES[name][1]})" for name in ordered)
    return f"WITH RECURSIVE {ctes}\n{final}"


# --- articles --------------------------------------------------------------------------

define(
    "news",
    [],
    """
SELECT doc_id + 1 AS "index", source AS topic, day AS date_extract,
       CASE WHEN length(title) <= 120 THEN CAST(day - INTERVAL 1 DAY AS DATE) END AS date_article,
       text AS content, source AS portal,
       CASE WHEN lang = 'de' THEN 'https://' ELSE 'https://www.' END
         || source || '.example/' || md5(title) AS link,
       title, title AS summary_llm, """
    + clean("text")
    + """ AS summary, 'n-a' AS authors, lang AS state,
       CASE WHEN lang <> 'fr' THEN lang || '-' || source END AS city,
       sha256(text) AS content_hash, n_chars AS content_nchar, doc_id
FROM (SELECT *, split_part(text, chr(10), 1) AS title,
             CAST(DATE '2023-08-01' + CAST(3 * CAST(substr(source, 4) AS INTEGER) AS INTEGER) AS DATE) AS day
      FROM documents)""",
)
define(
    "labelled", ["news"], 'SELECT * FROM news WHERE doc_id IN (SELECT doc_id FROM labels)'
)
define(
    "consolidated",
    ["news"],
    """
SELECT n.* FROM news n
WHERE "index" IN (
  SELECT min("index") FROM (
    SELECT "index", link FROM news
    WHERE "index" IN (SELECT min("index") FROM news GROUP BY content_hash)
  ) GROUP BY link)""",
)

# --- words and vectors -----------------------------------------------------------------

define("doc_words", [], f"SELECT doc_id, unnest({words('text')}) AS word FROM documents")
define(
    "vocab",
    ["doc_words"],
    """
SELECT row_number() OVER (ORDER BY n DESC, word) - 1 AS rank, word
FROM (SELECT word, count(*) AS n FROM doc_words WHERE length(word) > 3 GROUP BY word
      ORDER BY n DESC, word)""",
)
define(
    "vecs",
    ["vocab"],
    """
SELECT rank, word, CAST(embedding AS DOUBLE[]) AS vec
FROM vocab JOIN embeddings ON vec_id = rank""",
)
define(
    "sims",
    ["vecs"],
    f"""
SELECT v.word, k.pos,
       coalesce(list_inner_product(v.vec, kv.vec)
         / (sqrt(list_inner_product(v.vec, v.vec)) * sqrt(list_inner_product(kv.vec, kv.vec))), 0)
         AS sim
FROM vecs v CROSS JOIN (VALUES {keyword_values(b.KEYWORDS)}) k(pos, keyword)
LEFT JOIN vecs kv ON kv.word = k.keyword""",
)
define(
    "best",
    ["doc_words", "sims"],
    f"""
SELECT doc_id, pos, max(sim) AS best
FROM (SELECT DISTINCT doc_id, word FROM doc_words WHERE word NOT IN ({listed(b.STOP_WORDS)}))
JOIN sims USING (word) GROUP BY doc_id, pos""",
)
define(
    "scores",
    ["best"],
    f"""
SELECT d.doc_id, round(coalesce(sum(best), 0) / {len(b.KEYWORDS)}, 4) AS score
FROM documents d LEFT JOIN best USING (doc_id) GROUP BY d.doc_id""",
)

# --- stems -----------------------------------------------------------------------------


def stem_tables(prefix: str, source: str, needs: Sequence[str]) -> str:
    """Tables that stem the column ``word`` of ``source``; returns the last one."""
    pron = stem.PRONOUN
    rv = f"regexp_extract(w, {q(stem.REGION_V)}, 1)"
    r1 = f"regexp_extract(w, {q(stem.REGION_1)}, 1)"

    def cut(match: str) -> str:
        return f"substr(w, 1, length(w) - length({match}))"

    names = [f"{prefix}{i}" for i in range(6)]
    define(names[0], needs, f"SELECT word, word AS w, {rv} AS rv FROM {source}")
    define(
        names[1],
        [names[0]],
        f"""
SELECT word, CASE WHEN regexp_matches(rv, {q(stem.VERB_BEFORE_PRONOUN + pron + '$')})
  OR (regexp_matches(rv, {q('yendo' + pron + '$')}) AND regexp_matches(w, {q('uyendo' + pron + '$')}))
  THEN translate(regexp_replace(w, {q(pron + '$')}, ''), 'áéí', 'aei') ELSE w END AS w
FROM {names[0]}""",
    )
    define(
        names[2],
        [names[1]],
        f"SELECT word, w, r1, regexp_extract(r1, {q(stem.REGION_1)}, 1) AS r2, {rv} AS rv "
        f"FROM (SELECT *, {r1} AS r1 FROM {names[1]})",
    )
    extra = f"regexp_extract(r2, {q(stem.ADVERB_EXTRA)})"
    deleted = f"regexp_extract(r2, {q(stem.DELETED)})"
    define(
        names[3],
        [names[2]],
        f"""
SELECT word, w, rv, CASE
  WHEN w LIKE '%amente' THEN CASE WHEN {extra} <> '' THEN {cut(extra)}
    WHEN r1 LIKE '%amente' THEN {cut("'amente'")} ELSE w END
  WHEN regexp_matches(r2, {q(stem.TO_LOG)}) THEN regexp_replace(w, {q(stem.TO_LOG)}, 'log')
  WHEN regexp_matches(r2, {q(stem.TO_U)}) THEN regexp_replace(w, {q(stem.TO_U)}, 'u')
  WHEN regexp_matches(r2, {q(stem.TO_ENTE)}) THEN regexp_replace(w, {q(stem.TO_ENTE)}, 'ente')
  ELSE {cut(deleted)} END AS w1
FROM {names[2]}""",
    )
    y = f"regexp_extract(rv, {q(stem.Y_VERB)})"
    verb = f"regexp_extract(rv, {q(stem.VERB)})"
    define(
        names[4],
        [names[3]],
        f"""
SELECT word, CASE WHEN w1 <> w THEN w1
  WHEN y <> '' AND suffix(w, 'u' || y) THEN {cut("y")}
  WHEN regexp_matches(v, {q('^' + stem.E_VERB + '$')}) AND suffix({cut("v")}, 'gu')
    THEN substr(w, 1, length(w) - length(v) - 1)
  ELSE {cut("v")} END AS w
FROM (SELECT *, {y} AS y, {verb} AS v FROM {names[3]})""",
    )
    residue = f"regexp_extract(rv, {q(stem.RESIDUE)})"
    define(
        names[5],
        [names[4]],
        f"""
SELECT word, translate(CASE WHEN regexp_matches(rv, 'u[eé]$') AND regexp_matches(w, 'gu[eé]$')
  THEN substr(w, 1, length(w) - 2) ELSE {cut(residue)} END, 'áéíóú', 'aeiou') AS stem
FROM (SELECT *, {rv} AS rv FROM {names[4]})""",
    )
    return names[5]


define("vocab_words", ["doc_words"], "SELECT DISTINCT word FROM doc_words")
STEMS = stem_tables("st", "vocab_words", ["vocab_words"])


def match_tables(prefix: str, table: str, key: str, column: str, keywords: Sequence[str], stops: bool) -> str:
    """Keyword hits per row by stemming every single token."""
    tokens = words(column, fold=True)
    kw_tokens = words("k", fold=True)
    if stops:
        tokens, kw_tokens = no_stops(tokens), no_stops(kw_tokens)
    define(f"{prefix}_tok", [], f"SELECT {key}, {tokens} AS toks FROM {table}")
    define(
        f"{prefix}_kw",
        [],
        f"SELECT DISTINCT unnest({kw_tokens}) AS word FROM (VALUES "
        + ", ".join(f"({q(k)})" for k in keywords)
        + ") t(k)",
    )
    define(
        f"{prefix}_all",
        [f"{prefix}_tok", f"{prefix}_kw"],
        f"SELECT word FROM (SELECT DISTINCT unnest(toks) AS word FROM {prefix}_tok) "
        f"UNION SELECT word FROM {prefix}_kw",
    )
    stems = stem_tables(f"{prefix}_s", f"{prefix}_all", [f"{prefix}_all"])
    define(
        f"{prefix}_hit",
        [f"{prefix}_tok", stems],
        f"""
SELECT {key}, count(*) AS n, string_agg(stem, ' ' ORDER BY pos) AS matches
FROM (SELECT {key}, unnest(toks) AS word, generate_subscripts(toks, 1) AS pos FROM {prefix}_tok)
JOIN {stems} USING (word)
WHERE stem IN (SELECT stem FROM {stems} JOIN {prefix}_kw USING (word))
GROUP BY {key}""",
    )
    define(
        f"{prefix}_score",
        [f"{prefix}_hit"],
        f"""
SELECT {key}, CAST(len(toks) AS BIGINT) AS n_tokens, coalesce(n, 0) AS n_matches,
       CASE WHEN len(toks) > 0 THEN round(CAST(coalesce(n, 0) AS DOUBLE) / len(toks), 2) ELSE 0.0 END AS match_score,
       coalesce(matches, '') AS matches
FROM {prefix}_tok LEFT JOIN {prefix}_hit USING ({key})""",
    )
    return f"{prefix}_score"


DOC_MATCH = match_tables("dm", "documents", "doc_id", "text", b.STEM_KEYWORDS, True)
URL_MATCH = match_tables("um", "pages", "page_id", "url", b.URL_KEYWORDS, False)

# --- chunks and entities ---------------------------------------------------------------

define("clean_docs", [], f"SELECT doc_id, {clean('text')} AS t FROM documents")
# A span runs from a blank (or 0) to the last blank within 400 characters; the next one
# starts at the first blank of the last 60.
_END = (
    "CASE WHEN length(t) - {p} <= 400 THEN length(t) "
    "ELSE {p} + length(regexp_extract(substr(t, {p} + 1, 401), '^((?s).+) ', 1)) END"
)
define(
    "spans",
    ["clean_docs"],
    f"""
SELECT doc_id, t, CAST(0 AS BIGINT) AS p, CAST({_END.format(p='0')} AS BIGINT) AS e, 0 AS chunk_id
FROM clean_docs WHERE length(t) > 0
UNION ALL
SELECT doc_id, t, np, CAST({_END.format(p='np')} AS BIGINT), chunk_id + 1
FROM (SELECT *, CASE WHEN strpos(substr(t, e - 59, 60), ' ') = 0 THEN e
                ELSE e - 61 + strpos(substr(t, e - 59, 60), ' ') END AS np
      FROM spans WHERE e < length(t))""",
)
define(
    "word_chunks",
    ["spans"],
    """
SELECT doc_id, chunk_id, CAST(p + 1 + (p > 0)::INT AS INTEGER) AS chunk_start,
       trim(substr(t, p + 1, e - p)) AS chunk FROM spans""",
)


def _rule_rows(i: int) -> str:
    rule = DEFAULT_RULES[i]
    return f"""
SELECT doc_id, chunk_id, chunk_start, {q(rule.group)} AS entity_group, hits[i] AS word,
       CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g)))
            + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS INTEGER) AS "start"
FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i
      FROM (SELECT doc_id, chunk_id, chunk_start, regexp_extract_all(chunk, {q(rule.pattern)}) AS hits,
                   regexp_split_to_array(chunk, {q(rule.pattern)}) AS gaps FROM word_chunks)
      WHERE len(hits) > 0)"""


define(
    "ner",
    ["word_chunks"],
    """
SELECT doc_id + 1 AS "index", chunk_id, entity_group, round(length(word) / 100.0::DOUBLE, 2) AS score,
       word, "start", CAST("start" + length(word) AS INTEGER) AS "end",
       CAST(chunk_start - 1 + "start" AS BIGINT) AS doc_start
FROM ("""
    + "\nUNION ALL\n".join(_rule_rows(i) for i in range(len(DEFAULT_RULES)))
    + ")",
)


def _consolidate(source: str) -> str:
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY "index", word ORDER BY score DESC, "start", entity_group, chunk_id) AS rn
  FROM (SELECT * REPLACE (regexp_replace(regexp_replace(word, '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS word)
        FROM {source})
  WHERE word <> '') WHERE rn = 1"""


define("ner_one", ["ner"], _consolidate("ner"))
define(
    "ner_report",
    ["ner", "consolidated"],
    _consolidate('(SELECT * FROM ner WHERE "index" IN (SELECT "index" FROM consolidated))'),
)
define(
    "persons",
    ["ner_report"],
    """
SELECT word, "index" FROM ner_report
WHERE entity_group = 'PER' AND NOT regexp_matches(word, '^\\p{N}+$') AND contains(word, ' ')""",
)
define(
    "top30",
    ["persons"],
    "SELECT word, count(*) AS occurrences FROM persons GROUP BY word ORDER BY occurrences DESC, word LIMIT 30",
)
define(
    "edges",
    ["persons", "top30"],
    'SELECT DISTINCT word, CAST("index" AS VARCHAR) AS article FROM persons WHERE word IN (SELECT word FROM top30)',
)
_SUMS = ", ".join(
    f"CAST(sum({c}) AS BIGINT) AS {c}"
    for c in ("cantidad_noticias", "personas", "lugares", "organizaciones", "varios")
)
define(
    "stats",
    ["consolidated", "ner_report"],
    f"""
SELECT CAST(row_number() OVER (ORDER BY total, cantidad_noticias DESC, state) AS INTEGER) AS pos,
       CASE WHEN total = 1 THEN 'Total' ELSE state END AS provincia,
       cantidad_noticias, personas, lugares, organizaciones, varios
FROM (
  SELECT state, grouping(state) AS total, {_SUMS}
  FROM (SELECT state, count(*) AS cantidad_noticias FROM consolidated WHERE state <> {q(b.NATIONAL)} GROUP BY state)
  LEFT JOIN (
    SELECT state, nullif(count(*) FILTER (entity_group = 'PER'), 0) AS personas,
           nullif(count(*) FILTER (entity_group = 'LOC'), 0) AS lugares,
           nullif(count(*) FILTER (entity_group = 'ORG'), 0) AS organizaciones,
           nullif(count(*) FILTER (entity_group = 'MISC'), 0) AS varios
    FROM ner_report JOIN consolidated USING ("index") GROUP BY state) USING (state)
  GROUP BY ROLLUP (state))""",
)


# --- summaries -------------------------------------------------------------------------


def summary_tables(prefix: str, source: str, key: str, column: str, needs: Sequence[str]) -> str:
    parts = (
        f"list_filter(list_transform(regexp_extract_all({clean(column)}, '[^.!?]*(?:[.!?]+[^.!?\\s][^.!?]*)*[.!?]*'), "
        "lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')), lambda s: s <> '')"
    )
    define(f"{prefix}_parts", needs, f"SELECT {key}, {parts} AS parts FROM {source}")
    define(
        f"{prefix}_tok",
        [f"{prefix}_parts"],
        f"""
SELECT {key}, pos, unnest({no_stops(words('parts[pos]'))}) AS word
FROM (SELECT {key}, parts, unnest(range(1, len(parts) + 1)) AS pos FROM {prefix}_parts)""",
    )
    define(
        f"{prefix}_rank",
        [f"{prefix}_tok"],
        f"""
SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, pos) AS rn,
       sum(n) OVER (PARTITION BY {key} ORDER BY score DESC, pos ROWS UNBOUNDED PRECEDING) AS used
FROM (SELECT {key}, pos, sum(tf) / count(*) AS score, count(*) AS n
      FROM (SELECT *, CAST(count(*) OVER (PARTITION BY {key}, word) AS DOUBLE) AS tf FROM {prefix}_tok)
      GROUP BY {key}, pos)""",
    )
    define(
        f"{prefix}_sum",
        [f"{prefix}_rank", f"{prefix}_parts"],
        f"""
SELECT p.{key}, coalesce(string_agg(p.parts[r.pos], ' ' ORDER BY r.pos), '') AS summary
FROM {prefix}_parts p LEFT JOIN {prefix}_rank r
  ON r.{key} = p.{key} AND r.rn <= 5 AND (r.used <= 400 OR r.rn = 1)
GROUP BY p.{key}""",
    )
    return f"{prefix}_sum"


DOC_SUMMARY = summary_tables("sm", "documents", "doc_id", "text", [])

# --- pages -----------------------------------------------------------------------------

SEEN = (
    "regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), "
    "'(?is)<script[ >].*?</script *>|<style[ >].*?</style *>', '', 'g')"
)
BLOCKS = (
    "ul ol li dl dt dd table thead tbody tfoot td th tr div section article aside main header footer nav form fieldset "
    "figure details blockquote address pre hr h1 h2 h3 h4 h5 h6 body html"
).split()
_CLOSE = "(?is)<(?:/p|/?(?:" + "|".join(BLOCKS) + "))(?:[^a-z0-9].*)?$"
_DECODED = "replace(replace({}, '&quot;', '\"'), '&amp;', '&')"

# The only character references in titles and paragraphs are &amp; and &quot;.
define(
    "page_texts",
    [],
    "SELECT page_id, url, nullif("
    + _DECODED.format("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
    + ", '') AS title, "
    + _DECODED.format(
        f"array_to_string(list_transform((regexp_split_to_array({SEEN}, '(?i)<p(?:>|/>|\\s[^>]*>)'))[2:], "
        f"lambda p: regexp_replace(regexp_replace(p, {q(_CLOSE)}, ''), '</?[A-Za-z][^>]*>', '', 'g')), ' ')"
    )
    + " AS content FROM pages",
)
define(
    "page_hits",
    [URL_MATCH, "sims"],
    f"""
SELECT page_id, url, {host("url")} AS host, score, n_matches > 0 AS match1,
       n_matches > 0 AND coalesce(score, 0) > 0.2 AS match2
FROM pages JOIN {URL_MATCH} USING (page_id) LEFT JOIN (
  SELECT page_id, round(sum(best) / {len(b.KEYWORDS)}, 4) AS score FROM (
    SELECT page_id, pos, max(sim) AS best
    FROM (SELECT DISTINCT page_id, unnest({words("html")}) AS word FROM pages) JOIN sims USING (word)
    GROUP BY page_id, pos) GROUP BY page_id) USING (page_id)""",
)
define(
    "portals",
    [],
    f"""
SELECT {host("url")} AS host, regexp_extract(url, '://[^/]+/([a-z]+)', 1) AS state,
       upper(regexp_extract(url, '://[^/]+/([a-z]+)', 1)) AS city FROM pages
UNION SELECT source || '.example', lang, NULL FROM documents""",
)
define(
    "run_pages",
    ["page_texts", "page_hits", "portals"],
    f"""
SELECT * FROM (
  SELECT page_id, {q(b.RUN_STAMP)} AS date_extract,
         CASE WHEN starts_with(url, 'https') THEN '2023-08-16' ELSE {q(b.RUN_STAMP)} END AS date_article, 'feeds' AS topic,
         content, url AS link, score AS link_sim_score, coalesce(title, 'na') AS title,
         coalesce(nullif(array_to_string(list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1), '/'),
           lambda x: x <> ''), '-'), ''), 'n-a') AS authors,
         host AS portal, state, city, sha256(content) AS content_hash, length(content) AS content_nchar
  FROM page_texts JOIN page_hits USING (page_id, url)
  LEFT JOIN (SELECT host, min(state) AS state, upper(min(state)) AS city FROM portals GROUP BY host) USING (host)
  WHERE match2 AND NOT contains(url, '#') AND length(content) > 400)
QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY page_id) = 1""",
)
RUN_SUMMARY = summary_tables("rs", "run_pages", "page_id", "content", ["run_pages"])

# --- embeddings and tf-idf -------------------------------------------------------------


def mean_vector(key: str, source_words: str) -> str:
    return f"""
SELECT {key}, CAST(dim - 1 AS INTEGER) AS dim, round(CAST(CAST(avg(vec[dim]) AS FLOAT) AS DOUBLE), 3) AS "value"
FROM (SELECT {key}, vec, unnest(range(1, 65)) AS dim FROM ({source_words}) JOIN vecs USING (word))
GROUP BY {key}, dim"""


define(
    "term_counts",
    [],
    f"""
SELECT doc_id, term, count(*) AS tf
FROM (SELECT doc_id, unnest({no_stops("regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')")}) AS term
      FROM documents) GROUP BY doc_id, term""",
)
define(
    "tfidf",
    ["term_counts"],
    """
SELECT doc_id, term, tf, df, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight
FROM (SELECT doc_id, term, tf, df,
             tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)::DOUBLE) + 1) AS raw
      FROM term_counts JOIN (SELECT term, count(*) AS df FROM term_counts GROUP BY term) USING (term))""",
)

# --- ingest ----------------------------------------------------------------------------

define(
    "landed",
    ["news"],
    """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY batch_id, link, date_article, title) AS rn
  FROM (SELECT *, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 0 ELSE 1 END AS batch_id FROM news))
WHERE rn = 1 AND length(content) > 0""",
)
define(
    "stored",
    ["landed"],
    f"""
SELECT row_number() OVER (ORDER BY batch_id, content_hash) AS id, batch_id, content_hash, link,
       date_extract, content_nchar, {clean('content')} AS cleaned, doc_id
FROM landed""",
)
STORED_SUMMARY = summary_tables("ss", "stored", "id", "cleaned", ["stored"])
define(
    "stored_scores",
    [STORED_SUMMARY, "sims"],
    f"""
SELECT s.id, round(coalesce(sum(best), 0) / {len(b.KEYWORDS)}, 4) AS score
FROM {STORED_SUMMARY} s LEFT JOIN (
  SELECT id, pos, max(sim) AS best
  FROM (SELECT DISTINCT id, unnest({no_stops(words('summary'))}) AS word FROM {STORED_SUMMARY})
  JOIN sims USING (word) GROUP BY id, pos) USING (id)
GROUP BY s.id""",
)

FUNNEL = """
  count(c.url) = 0 AS fail_build, count(c.url) AS total_articles,
  count(*) FILTER (c.match1) AS match1_url, count(*) FILTER (c.match2) AS match2_url_topic_related,
  round(coalesce(CAST(count(*) FILTER (c.match2) AS DOUBLE) / nullif(count(c.url), 0), 0), 4) AS related_ratio"""
BAND = "CASE WHEN score > 0.5 THEN 'above 0.5' WHEN score > 0.44 THEN '0.44 to 0.5' ELSE '0.44 or less' END"
CHAR_SLICES = "unnest(regexp_extract_all(text, '(?s).{1,100}')) AS piece, unnest(range(0, len(regexp_extract_all(text, '(?s).{1,100}')))) AS pos"

ORACLE: dict[str, str] = {
    "clean_content": f"SELECT doc_id, length(text) AS n_raw, strlen(text) AS n_bytes, {clean('text')} AS content, "
    f"length({clean('text')}) AS n_clean FROM documents",
    "content_hash": "SELECT doc_id, sha256(text) AS content_hash FROM documents",
    "length_filter": "SELECT doc_id + 1 AS \"index\", n_chars AS content_nchar FROM documents WHERE length(text) > 400",
    "date_parts": "SELECT event_id, CAST(ts AS DATE) AS day, CAST(ts AS DATE) AS prefix_day, "
    "strftime(ts, '%Y-%m-%d') AS iso_day FROM events",
    "null_profile": build(
        ["news"],
        'SELECT unnest(c) AS "column", unnest(n) AS nulls FROM (SELECT '
        "['index','date_article','title','city','state','quality','toxic'] AS c, "
        'list_value(count(*) - count("index"), count(*) - count(date_article), count(*) - count(title), '
        "count(*) - count(city), count(*) - count(state), count(*) - count(quality), count(*) - count(toxic)) AS n "
        "FROM news LEFT JOIN labels USING (doc_id))",
    ),
    "link_parts": build(
        ["news"],
        f'SELECT "index", {portal("link")} AS portal, {host("link")} AS host, '
        "regexp_replace(link, '^https://www\\.', '') AS bare, "
        "regexp_replace(replace(link, 'https://www.', ''), '[^\\p{L}\\p{N}_\\s]', ' ', 'g') AS words, "
        "'\\href{' || link || '}{link}' AS hyperlink FROM news",
    ),
    "text_slices": f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, piece FROM (SELECT doc_id, {CHAR_SLICES} FROM documents)",
    "joined_text": build(
        ["news"],
        "SELECT \"index\", state || ' ' || city || ' ' || title || ' ' || summary_llm AS tit_summary, "
        "CAST(len(regexp_extract_all(content, '[^\\s]+')) AS BIGINT) AS n_words FROM news",
    ),
    "phrase_filter": build(
        ["news"],
        "SELECT \"index\", link FROM news WHERE contains(content, 'tion') AND NOT contains(content, 'License')",
    ),
    "portal_counts": build(["news"], f'SELECT {host("link")} AS host, count(*) AS n FROM news GROUP BY 1'),
    "dedup_content": build(
        ["news"],
        'SELECT "index", content_hash, link FROM news '
        'WHERE "index" IN (SELECT min("index") FROM news GROUP BY content_hash)',
    ),
    "consolidate_news": build(["consolidated"], 'SELECT "index", link, content_hash FROM consolidated'),
    "duplicate_flag": build(
        ["news"],
        'SELECT "index", content_hash, count(*) OVER (PARTITION BY content_hash) AS copies, '
        "count(*) OVER (PARTITION BY content_hash) > 1 AS duplicated FROM news",
    ),
    "unduplicated": build(
        ["news"],
        'SELECT "index", content_hash FROM news QUALIFY count(*) OVER (PARTITION BY content_hash) = 1',
    ),
    "dedup_against_store": build(
        ["labelled"],
        'SELECT "index", link, content_hash FROM news WHERE content_hash NOT IN (SELECT content_hash FROM labelled)',
    ),
    "dup_top10": build(
        ["news"],
        "SELECT link, date_article, count(*) AS count_ocurrence, round(avg(length(content)), 4) AS avg_content_length "
        "FROM news GROUP BY link, date_article ORDER BY count_ocurrence DESC, link, date_article NULLS FIRST LIMIT 10",
    ),
    "word_counts": build(
        ["doc_words"],
        f"SELECT word, count(*) AS n FROM doc_words WHERE word NOT IN ({listed(b.STOP_WORDS)}) GROUP BY word",
    ),
    "match_token_counts": f"SELECT doc_id, CAST(len({no_stops(words('text', fold=True))}) AS BIGINT) AS n_fold_first, "
    f"CAST(len({no_stops(words('text'))}) AS BIGINT) AS n_stop_first FROM documents",
    "stem_vocab": build([STEMS], f"SELECT word, stem FROM {STEMS}"),
    "keyword_match_score": build(
        [DOC_MATCH], f"SELECT doc_id, n_tokens, match_score, n_matches, matches FROM {DOC_MATCH}"
    ),
    "any_keyword": "SELECT doc_id FROM documents WHERE "
    + " OR ".join(f"contains(lower(text), {q(k)})" for k in b.KEYWORDS),
    "text_volume": "SELECT source, count(*) AS total_articles, count(*) FILTER (related) AS related_articles, "
    "CAST(sum(length(text)) AS BIGINT) AS total_text_analysed, "
    "CAST(coalesce(sum(length(text)) FILTER (related), 0) AS BIGINT) AS total_text_related FROM (SELECT *, "
    + " OR ".join(f"contains(lower(text), {q(k)})" for k in b.KEYWORDS)
    + " AS related FROM documents) GROUP BY source",
    "word_vectors": build(
        ["vecs"], "SELECT rank, word, round(sqrt(list_inner_product(vec, vec)), 4) AS norm FROM vecs"
    ),
    "topic_similarity_many": build(
        ["doc_words", "vecs"],
        f"""
SELECT d.doc_id, round(coalesce(sum(best), 0) / (SELECT count(*) FROM vecs WHERE rank < 2000), 4) AS score
FROM documents d LEFT JOIN (
  SELECT doc_id, pos, max(sim) AS best
  FROM (SELECT DISTINCT doc_id, word FROM doc_words WHERE word NOT IN ({listed(b.STOP_WORDS)}))
  JOIN (
    SELECT v.word, k.rank AS pos, list_inner_product(v.vec, k.vec)
      / (sqrt(list_inner_product(v.vec, v.vec)) * sqrt(list_inner_product(k.vec, k.vec))) AS sim
    FROM vecs v, vecs k WHERE k.rank < 2000
  ) USING (word) GROUP BY doc_id, pos
) USING (doc_id) GROUP BY d.doc_id""",
    ),
    "vocabulary_similarity": build(
        ["sims"], "SELECT word, CAST(pos AS INTEGER) AS keyword, round(sim, 4) AS sim FROM sims"
    ),
    "topic_similarity": build(["scores"], "SELECT doc_id, score FROM scores"),
    "single_keyword_similarity": build(
        ["best"],
        "SELECT d.doc_id, round(coalesce(best, 0), 4) AS score FROM documents d "
        "LEFT JOIN (SELECT * FROM best WHERE pos = 2) USING (doc_id)",
    ),
    "relevance_split": build(
        ["scores"],
        f"SELECT score >= {b.THRESHOLD} AS positive, {BAND} AS band, count(*) AS n FROM scores GROUP BY 1, 2",
    ),
    "best_keyword": build(
        ["best"],
        f"SELECT d.doc_id, k.keyword FROM documents d "
        "LEFT JOIN (SELECT doc_id, min(pos) AS pos FROM best WHERE best > 0.3 GROUP BY doc_id) USING (doc_id) "
        f"LEFT JOIN (VALUES {keyword_values(b.KEYWORDS)}) k(pos, keyword) USING (pos)",
    ),
    "funnel_by_source": build(
        [DOC_MATCH, "scores"],
        f"SELECT p.source AS url, {FUNNEL} FROM (SELECT DISTINCT source FROM documents) p LEFT JOIN ("
        "SELECT source AS url, n_matches > 0 AS match1, n_matches > 0 AND score > 0.45 AS match2 "
        f"FROM documents JOIN {DOC_MATCH} USING (doc_id) JOIN scores USING (doc_id)) c ON c.url = p.source GROUP BY p.source",
    ),
    "page_links": "SELECT DISTINCT page_id, CASE "
    "WHEN regexp_matches(h, '(?i)^https?:') THEN h "
    "WHEN starts_with(h, '//') THEN regexp_extract(url, '^([A-Za-z]+:)', 1) || h "
    "WHEN starts_with(h, '/') THEN regexp_extract(url, '^([A-Za-z]+://[^/?#]+)', 1) || h "
    "ELSE regexp_extract(url, '^([A-Za-z]+://[^?#]*/)', 1) || h END AS link "
    f"FROM (SELECT page_id, url, trim(unnest(regexp_extract_all({SEEN}, "
    """'(?i)<a[ \\t\\n](?:[^>]*?\\s)?href *= *("[^"]*"|[^ ">]+)', 1)), '"') AS h FROM pages) WHERE h NOT LIKE '#%'""",
    "page_text": build(["page_texts"], "SELECT page_id, title, content FROM page_texts"),
    "extract_stats": build(
        ["page_hits", "portals"],
        f"SELECT {q(b.RUN_STAMP)} AS date_extract, 'feeds' AS topic, p.host AS url, {FUNNEL} "
        "FROM (SELECT DISTINCT host FROM portals) p LEFT JOIN page_hits c ON c.host = p.host GROUP BY p.host",
    ),
    "extract_run": build(
        ["run_pages", RUN_SUMMARY],
        "SELECT page_id, date_extract, date_article, topic, content, link, link_sim_score, title, authors, portal, state, city, "
        f"content_hash, content_nchar, summary FROM run_pages JOIN {RUN_SUMMARY} USING (page_id)",
    ),
    "url_match": build([URL_MATCH], f"SELECT page_id, n_tokens, match_score, matches FROM {URL_MATCH}"),
    "url_probe": build(
        [URL_MATCH],
        f"SELECT page_id, url, match_score, matches FROM {URL_MATCH} JOIN pages USING (page_id) "
        "WHERE regexp_matches(url, 'utm_source|spam')",
    ),
    "page_funnel": build(
        [URL_MATCH, "sims"],
        f"SELECT p.host, {FUNNEL} FROM (SELECT DISTINCT {host('url')} AS host FROM pages) p LEFT JOIN ("
        f"SELECT url, {host('url')} AS host, n_matches > 0 AS match1, n_matches > 0 AND coalesce(score, 0) > 0.2 AS match2 "
        f"FROM pages JOIN {URL_MATCH} USING (page_id) LEFT JOIN ("
        f"SELECT page_id, round(sum(best) / {len(b.KEYWORDS)}, 4) AS score FROM ("
        "SELECT page_id, pos, max(sim) AS best FROM ("
        f"SELECT DISTINCT page_id, unnest({words('html')}) AS word FROM pages) JOIN sims USING (word) "
        "GROUP BY page_id, pos) GROUP BY page_id) USING (page_id)) c ON c.host = p.host GROUP BY p.host",
    ),
    "chunks_fixed": build(
        ["clean_docs"],
        "SELECT doc_id, CAST(i AS INTEGER) AS chunk_id, CAST(340 * i + 1 AS INTEGER) AS chunk_start, "
        "substr(t, 340 * i + 1, 400) AS chunk FROM (SELECT doc_id, t, "
        "unnest(range(0, CAST(ceil(greatest(length(t) - 60, 1) / 340.0) AS BIGINT))) AS i FROM clean_docs WHERE length(t) > 0)",
    ),
    "chunks_words": build(["word_chunks"], "SELECT doc_id, chunk_id, chunk_start, chunk FROM word_chunks"),
    "entities_rules": build(
        ["ner"], 'SELECT "index", chunk_id, entity_group, score, word, "start", "end", doc_start FROM ner'
    ),
    "consolidate_entities": build(
        ["ner_one"], 'SELECT "index", word, entity_group, score, chunk_id, "start" FROM ner_one'
    ),
    "entities_gazetteer": build(
        ["ner_one", "clean_docs"],
        "SELECT doc_id + 1 AS \"index\", word || ' ' || next AS word, 'PER' AS entity_group, CAST(1 AS DOUBLE) AS score, "
        "CAST(\"start\" AS INTEGER) AS \"start\", CAST(next_start + length(next) AS INTEGER) AS \"end\" FROM ("
        "SELECT *, lead(word) OVER w AS next, lead(\"start\") OVER w AS next_start FROM ("
        "SELECT *, sum(gap + length(word)) OVER (PARTITION BY doc_id ORDER BY i) - length(word) AS \"start\" FROM ("
        "SELECT doc_id, unnest(hits) AS word, unnest(range(1, len(hits) + 1)) AS i, "
        "unnest(list_transform(gaps[1:len(hits)], lambda g: length(g))) AS gap FROM ("
        "SELECT doc_id, regexp_extract_all(t, '[\\p{L}\\p{N}_]+') AS hits, regexp_split_to_array(t, '[\\p{L}\\p{N}_]+') AS gaps "
        "FROM clean_docs))) WINDOW w AS (PARTITION BY doc_id ORDER BY i)) "
        "WHERE word || ' ' || next IN (SELECT word FROM ner_one WHERE entity_group = 'PER' AND contains(word, ' '))",
    ),
    "province_stats": build(["stats"], "SELECT * FROM stats"),
    "province_chart": build(
        ["stats"], "SELECT pos, provincia, cantidad_noticias FROM stats WHERE provincia <> 'Total'"
    ),
    "state_entity_counts": build(
        ["ner_report"],
        'SELECT state, entity_group, count(*) AS "count" FROM ner_report JOIN consolidated USING ("index") '
        f"WHERE state <> {q(b.NATIONAL)} GROUP BY state, entity_group",
    ),
    "article_table": build(
        ["consolidated"],
        'SELECT "index" AS "Ref.art", state AS "Pcia_Estado", '
        "strftime(coalesce(date_article, date_extract), '%Y-%m-%d') AS fecha_art, "
        f"coalesce(CASE WHEN {portal('link')} = 'src0' THEN 'Gendarmería' ELSE {portal('link')} END, 'n-a') AS portal, "
        "authors AS autores, title AS titular, "
        "CASE WHEN state = 'de' THEN substr(summary, 1, 300) ELSE summary_llm END AS resumen, link, "
        "'\\href{' || link || '}{link}' AS hyperlink FROM consolidated",
    ),
    "entity_table": build(
        ["ner_report"],
        'SELECT "index" AS "Ref.art", '
        + ", ".join(
            f"string_agg(word, '; ' ORDER BY word) FILTER (entity_group = {q(g)}) AS {c}"
            for g, c in (("PER", "personas"), ("LOC", "lugares"), ("ORG", "organizaciones"), ("MISC", "varios"))
        )
        + ' FROM ner_report GROUP BY "index"',
    ),
    "person_network": build(
        ["persons"],
        'SELECT word, "index" // 10000 AS part, string_agg(CAST("index" AS VARCHAR), \',\' ORDER BY "index") AS articles, '
        "CAST(sum(count(*)) OVER (PARTITION BY word) AS BIGINT) AS occurrences FROM persons GROUP BY word, part",
    ),
    "top_persons": build(["top30"], "SELECT word, occurrences FROM top30"),
    "network_edges": build(["edges"], "SELECT word, article FROM edges"),
    "network_nodes": build(
        ["edges"],
        "SELECT node, min(type) AS type FROM (SELECT word AS node, 'word' AS type FROM edges UNION ALL "
        "SELECT article, 'article' FROM edges) GROUP BY node",
    ),
    "store_range": build(
        ["news"],
        "SELECT \"index\", topic, date_extract, date_article, title, content_nchar FROM news "
        "WHERE date_extract BETWEEN DATE '2023-08-16' AND DATE '2023-09-01' AND regexp_matches(topic, '(?i)SRC1')",
    ),
    "store_by_index": build(
        ["news"], 'SELECT "index", topic, state, link FROM news WHERE "index" BETWEEN 100 AND 853'
    ),
    "entities_for_articles": build(
        ["ner", "labelled"],
        'SELECT "index", entity_group, word, chunk_id, "start" FROM ner WHERE "index" IN (SELECT "index" FROM labelled)',
    ),
    "max_index": "SELECT max(doc_id) + 1 AS max_index FROM documents",
    "assign_ids": 'SELECT doc_id, n_chars, 1000 + row_number() OVER (ORDER BY n_chars, doc_id) AS "index" FROM documents',
    "delete_range": build(
        ["news"],
        "SELECT \"index\", topic, link FROM news "
        "WHERE NOT (\"index\" BETWEEN 100 AND 853 AND regexp_matches(topic, '(?i)src1'))",
    ),
    "delete_listed": build(
        ["news"],
        'SELECT "index", topic, link FROM news WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)',
    ),
    "topic_facts": "SELECT CAST(topic AS INTEGER) AS topic, CAST(10 AS BIGINT) AS n_words, true AS descending, true AS shares, true AS known "
    "FROM range(122) AS t(topic)",
    "dedup_indexed": build(
        ["labelled"],
        'SELECT "index", link, content_hash FROM news WHERE content_hash NOT IN (SELECT content_hash FROM labelled)',
    ),
    "store_compacted": build(
        ["labelled"],
        'SELECT "index", CAST(CASE WHEN "index" IN (SELECT "index" FROM labelled) THEN 0 ELSE 1 END AS BIGINT) AS batch_id, '
        "link, content_hash, date_extract, content_nchar FROM news WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)",
    ),
    "store_zones": build(
        ["news"],
        'SELECT "index", link, \'index\' AS "by" FROM news WHERE "index" BETWEEN 100 AND 853 UNION ALL '
        "SELECT \"index\", link, 'day' FROM news "
        "WHERE date_extract BETWEEN DATE '2023-08-16' AND DATE '2023-09-01' AND regexp_matches(topic, '(?i)SRC1')",
    ),
    "landed_articles": build(
        ["news"],
        "SELECT link, title, content_hash, state, city, strftime(date_article, '%Y-%m-%d') AS date_article, content_nchar, "
        "sha256(content) AS content_sha256 FROM news, range(2)",
    ),
    "extractive_summary": build([DOC_SUMMARY], f"SELECT doc_id, summary FROM {DOC_SUMMARY}"),
    "doc_embedding": build(
        ["doc_words", "vecs"],
        mean_vector(
            "doc_id", f"SELECT doc_id, word FROM doc_words WHERE word NOT IN ({listed(b.STOP_WORDS)})"
        ),
    ),
    "embedding_backfill": build(
        ["news", "vecs"],
        mean_vector(
            '"index"',
            f"SELECT \"index\", unnest({words('tit')}) AS word FROM (SELECT \"index\", "
            "state || ' ' || city || ' ' || title || ' ' || summary_llm AS tit FROM news "
            "WHERE doc_id NOT IN (SELECT vec_id FROM embeddings))",
        ),
    ),
    "bag_of_words": build(
        ["term_counts"],
        "SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM term_counts GROUP BY term",
    ),
    "tfidf_top_terms": build(
        ["tfidf"],
        'SELECT doc_id, CAST(rk AS INTEGER) AS "rank", term, tf, df, round(weight, 5) AS weight FROM ('
        "SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term) AS rk FROM tfidf) WHERE rk <= 10",
    ),
    "ingest_ordered": build(
        ["stored_scores", "ner"],
        f"""
SELECT id AS "index", CAST(batch_id + 1 AS BIGINT) AS batch_id, content_hash, link, date_extract, content_nchar,
       score AS summary_sim_score, coalesce(n, 0) AS n_entities, CAST(1 AS BIGINT) AS n_unparsed
FROM stored JOIN {STORED_SUMMARY} USING (id) JOIN stored_scores USING (id)
LEFT JOIN (SELECT "index" - 1 AS doc_id, count(*) AS n FROM ner GROUP BY 1) USING (doc_id)""",
    ),
    "ingest_stream": build(
        ["stored_scores", "ner"],
        f"""
SELECT id AS "index", CAST(batch_id AS BIGINT) AS batch_id, content_hash, link, date_extract, content_nchar,
       summary AS summary_llm, score AS summary_sim_score, coalesce(n, 0) AS n_entities
FROM stored JOIN {STORED_SUMMARY} USING (id) JOIN stored_scores USING (id)
LEFT JOIN (SELECT "index" - 1 AS doc_id, count(*) AS n FROM ner GROUP BY 1) USING (doc_id)""",
    ),
}
