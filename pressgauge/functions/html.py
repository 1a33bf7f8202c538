"""Paragraph text and links of stored pages, without leaving the JVM."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressgauge.functions.binding import let
from pressgauge.functions.text import strip_space

UNSEEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
P_OPEN = r"(?i)<p(?:\s[^>]*)?/?>"
# A paragraph ends at </p>, at the start of a block element, or where its container ends.
P_END = (
    r"(?is)<(?:/p|/?(?:address|article|aside|blockquote|body|dd|details|div|dl|dt"
    r"|fieldset|figure|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|pre|section"
    r"|table|tbody|td|th|tr|ul))\b.*$"
)
ANY_TAG = r"(?s)</?[A-Za-z][^>]*>"
# Character references end with a semicolon; numbers and the older names also stand without one.
NUMBER = r"^#(?:[0-9]+|[xX][0-9A-Fa-f]+);?"
NAMED = r"^([A-Za-z][A-Za-z0-9]{1,31};)"
OLD_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
OLD_NAMED = "^(" + "|".join(OLD_NAMES) + ")"
# In an attribute an older name without semicolon is text if more of a word or a value follows.
OLD_NAMED_IN_ATTRIBUTE = OLD_NAMED + "(?![=A-Za-z0-9])"
# Numbers 128 to 159 mean the characters of Windows-1252, where it has one.
WINDOWS = {
    code: ord(char)
    for code in range(128, 160)
    if (char := bytes([code]).decode("cp1252", "ignore"))
}
# An unquoted value ends at white space.
HREF = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def _windows(code: Column) -> Column:
    known = F.create_map(*[F.lit(v) for pair in sorted(WINDOWS.items()) for v in pair])
    return F.coalesce(F.try_element_at(known, code.cast("int")), code)


def _char(code: Column) -> Column:
    """Code point to character; invalid ones to the replacement character."""
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.decode(
        F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32"
    )


def _numbered(reference: Column) -> Column:
    """The character of a reference like ``#233;`` or ``#xE9;``."""
    digits = F.regexp_replace(reference, "^#[xX]?0*|;$", "")
    hexadecimal = reference.rlike("^#[xX]")
    code = F.when(F.length(digits) > 9, F.lit(0)).otherwise(
        F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("bigint")
    )
    return let(let(code, _windows), _char)


def _decode_one(piece: Column, names: Column, old_named: str) -> Column:
    """Text that followed an ampersand, with its character reference replaced."""

    def without(length: Column) -> Column:
        return F.substring(piece, length + 1, F.length(piece))

    number = F.regexp_extract(piece, NUMBER, 0)
    name = F.regexp_extract(piece, NAMED, 1)
    old = F.regexp_extract(piece, old_named, 1)
    return (
        F.when(F.startswith(piece, F.lit("amp;")), F.concat(F.lit("&"), F.substring(piece, 5, 1 << 30)))
        .when(number != "", F.concat(_numbered(number), without(F.length(number))))
        .when(F.map_contains_key(names, name), F.concat(F.element_at(names, name), without(F.length(name))))
        .when(old != "", F.concat(F.element_at(names, old), without(F.length(old))))
        .otherwise(F.concat(F.lit("&"), piece))
    )


def _after_first(parts: Column) -> Column:
    return F.slice(parts, F.lit(2), F.size(parts))


def unescape(c: Column, attribute: bool = False) -> Column:
    """Decode character references once, left to right, in text or in an attribute's value."""
    # One literal, which the optimizer reads once.
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    old_named = OLD_NAMED_IN_ATTRIBUTE if attribute else OLD_NAMED

    def decode(parts: Column) -> Column:
        rest = F.transform(_after_first(parts), lambda p: _decode_one(p, names, old_named))
        return F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))

    return let(
        c, lambda t: F.when(F.contains(t, F.lit("&")), let(F.split(t, "&"), decode)).otherwise(t)
    )


def paragraph_text(html: Column) -> Column:
    """Text of all paragraphs joined by one blank.

    Script, style and comments are skipped, a new paragraph closes an open one, so
    unclosed or nested paragraphs never repeat text.
    """
    pieces = F.split(F.regexp_replace(html, UNSEEN, ""), P_OPEN)

    def bodies(parts: Column) -> Column:
        return F.transform(
            _after_first(parts),
            lambda p: F.regexp_replace(F.regexp_replace(p, P_END, ""), ANY_TAG, ""),
        )

    return unescape(F.array_join(let(pieces, bodies), " "))


def page_title(html: Column) -> Column:
    inner = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.nullif(unescape(inner), F.lit(""))


def _without_dots(url: Column) -> Column:
    """An absolute address with ``.`` and ``..`` in its path resolved."""
    origin = F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*", 0)
    path = F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1)

    def step(kept: Column, part: Column) -> Column:
        # The first part is the empty one before the first slash, and stays.
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(part == ".", kept).when(part == "..", up).otherwise(F.concat(kept, F.array(part)))

    def joined(parts: Column) -> Column:
        last = F.element_at(parts, -1)
        kept = F.aggregate(parts, F.array().cast("array<string>"), step)
        end = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
        return F.concat(F.array_join(kept, "/"), end)

    tail = F.substring(url, F.length(origin) + F.length(path) + 1, F.length(url))
    dotted = url.rlike(r"^[A-Za-z]+://[^/?#]*(?:/[^?#]*)?/[.]{1,2}(?:[/?#]|$)")
    return F.when(dotted, F.concat(origin, let(F.split(path, "/"), joined), tail)).otherwise(url)


def article_links(url: Column, html: Column) -> Column:
    """Absolute web addresses that a page links to, duplicates removed.

    Links in comments and scripts, links into the page itself and other schemes than http and https do not count.
    """
    place = F.struct(
        F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1).alias("scheme"),
        F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1).alias("origin"),
        F.regexp_extract(url, r"^([^?#]*)", 1).alias("page"),
        F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^?#]*/)[^/?#]*(?:[?#].*)?$", 1).alias(
            "folder"
        ),
    )
    found = F.regexp_extract_all(F.regexp_replace(html, UNSEEN, ""), F.lit(HREF), F.lit(1))
    values = F.transform(found, lambda v: strip_space(unescape(F.regexp_replace(v, "^[\"']|[\"']$", ""), True)))
    hrefs = F.filter(
        values,
        lambda h: (h != "") & ~h.startswith("#") & (~h.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | h.rlike("(?i)^https?:")),
    )

    def absolute(at: Column) -> Column:
        own_host = F.concat(at["origin"], F.lit("/"))
        folder = F.when(F.length(at["folder"]) > F.length(own_host), at["folder"]).otherwise(own_host)
        page = F.when(F.length(at["page"]) > F.length(at["origin"]), at["page"]).otherwise(own_host)
        return F.transform(
            hrefs,
            lambda h: _without_dots(
                F.when(h.rlike(r"(?i)^https?:"), h)
                .when(h.startswith("//"), F.concat(at["scheme"], h))
                .when(h.startswith("/"), F.concat(at["origin"], h))
                .when(h.startswith("?"), F.concat(page, h))
                .otherwise(F.concat(folder, h))
            ),
        )

    return F.array_distinct(let(place, absolute))
