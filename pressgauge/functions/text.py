"""Text normalisation, hashing and slicing as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# The accent fold and the separators of the token rules.
ACCENTED = "áéíóúüñÁÉÍÓÚÜÑ"
UNACCENTED = "aeiouunAEIOUUN"
URL_SCHEME = r"https?://"
# Java's \W is ASCII-only and would cut accented words, hence the Unicode classes. One
# character class, not an alternation: Java recurses on the latter in long separators.
TOKEN_BREAK = r"[[^\p{L}\p{N}]0-9]+"


def spanish_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("spanish")


def fold_accents(c: Column) -> Column:
    """á→a … ñ→n; other characters are kept."""
    return F.translate(c, ACCENTED, UNACCENTED)


def words(c: Column, fold: bool = False) -> Column:
    """Lower-cased words with repeats; URL scheme, punctuation and digits separate."""
    plain = F.regexp_replace(F.lower(c), URL_SCHEME, "")
    if fold:
        plain = fold_accents(plain)
    return F.array_remove(F.split(plain, TOKEN_BREAK), "")


def spaced_words(c: Column) -> Column:
    """The words of :func:`words` as one string, a blank between them and none or one at its ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), URL_SCHEME, ""), TOKEN_BREAK, " ")


def without_stop_words(tokens: Column, stop_words: Sequence[str]) -> Column:
    """Drop stop words, keep order and repeats."""
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(list(stop_words)))


def similarity_tokens(c: Column, stop_words: Sequence[str] = ()) -> Column:
    """Distinct words for similarity: a maximum over words ignores repeats."""
    found = words(c)
    if stop_words:
        return F.array_except(found, F.array(*[F.lit(w) for w in stop_words]))
    return F.array_distinct(found)


def match_tokens(
    c: Column, stop_words: Sequence[str] = (), fold_before_stop: bool = True
) -> Column:
    """Folded words with repeats for keyword matching, not yet stemmed.

    Folding first lets accented stop words pass the filter; pass
    ``fold_before_stop=False`` to test stop words on the original spelling.
    """
    if fold_before_stop:
        return without_stop_words(words(c, fold=True), stop_words)
    return F.transform(without_stop_words(words(c), stop_words), fold_accents)


def strip_space(c: Column) -> Column:
    """Strip every kind of white space at both ends (``trim`` knows only blanks)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def clean_whitespace(c: Column) -> Column:
    """Line breaks and tabs to one blank, runs of white space to one blank, stripped."""
    flat = F.regexp_replace(c, r"[\n\t]+", " ")
    return strip_space(F.regexp_replace(flat, r"\s{2,}", " "))


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def char_count(c: Column) -> Column:
    return F.char_length(c).cast("bigint")


def byte_count(c: Column) -> Column:
    return F.octet_length(c).cast("bigint")


def portal_of_link(link: Column) -> Column:
    """Word after ``www`` and one character; null when there is none."""
    return F.nullif(F.regexp_extract(link, r"www.([\p{L}\p{N}_]+)", 1), F.lit(""))


def host_of_link(link: Column) -> Column:
    return F.lower(F.try_parse_url(link, F.lit("HOST")))


def drop_www_prefix(link: Column) -> Column:
    """First ``https://www.`` removed (anchored: Spark would replace every hit)."""
    return F.regexp_replace(link, r"^https://www\.", "")


def headline_words(link: Column, site: str) -> Column:
    """Link without the site prefix, punctuation to blanks."""
    if not site:
        rest = link
    else:
        rest = F.replace(link, F.lit(site), F.lit(""))
    return F.regexp_replace(rest, r"[^\p{L}\p{N}_\s]", " ")


def clean_entity(c: Column) -> Column:
    return strip_space(F.regexp_replace(c, r"[^\p{L}\p{N}_\s]", " "))


def concat_or_null(*parts: Column) -> Column:
    """Parts joined by blanks; null as soon as one part is null."""
    complete = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return F.when(complete, F.concat_ws(" ", *parts))


def join_authors(authors: Column, default: str = "n-a") -> Column:
    """Author list to ``a-b-c``; nobody known gives the default."""
    return F.when(F.size(authors) > 0, F.array_join(authors, "-")).otherwise(F.lit(default))


def text_or_default(c: Column, default: str = "na") -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def slices(c: Column, width: int = 100) -> Column:
    """Consecutive pieces of ``width`` characters, in one pass over the text."""
    return F.regexp_extract_all(c, F.lit(rf"(?s).{{1,{width}}}"), F.lit(0))


def hyperlink(link: Column) -> Column:
    return F.concat(F.lit("\\href{"), link, F.lit("}{link}"))


def contains_any(c: Column, terms: Sequence[str]) -> Column:
    """True when the lower-cased text holds one of the terms as a substring."""
    low = F.lower(c)
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(t)) for t in terms])


def word_count(c: Column) -> Column:
    """Blank-separated words."""
    return F.size(F.array_remove(F.split(c, r"\s+"), "")).cast("bigint")
