import datetime as dt

import pytest
from pyspark.sql import functions as F

from pressgauge.functions import dates, html, text
from pressgauge.functions.stem import spanish_stem
from pressgauge.functions.vectors import cosine, unit


def one(spark, column, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names))
    return df.select(column.alias("x")).first()["x"]


def test_accent_fold(spark):
    assert one(spark, text.fold_accents(F.col("a")), a="Ñandú, pingüino") == "Nandu, pinguino"


def test_words_keep_accents_and_split_at_digits(spark):
    got = one(spark, text.words(F.col("a")), a="https://www.x.com/narcotráfico_año-2023 b")
    assert got == ["www", "x", "com", "narcotráfico", "año", "b"]


def test_clean_whitespace(spark):
    assert one(spark, text.clean_whitespace(F.col("a")), a="\t a\n\n b   c \n") == "a b c"


def test_fold_before_stop_words_lets_accented_ones_pass(spark):
    stops = text.spanish_stop_words()
    assert "está" in stops and "esta" in stops
    assert one(spark, text.match_tokens(F.col("a"), ["está"]), a="está cerca") == ["esta", "cerca"]
    assert one(spark, text.match_tokens(F.col("a"), ["está"], False), a="está cerca") == ["cerca"]


def test_concat_is_null_with_a_null_part(spark):
    joined = text.concat_or_null(F.col("a"), F.col("b"))
    assert one(spark, joined, a="x", b="y") == "x y"
    assert one(spark, joined, a="x", b=None) is None


def test_dates(spark):
    good, bad = "2023-08-16 13:55:01", "2023-13-01 10:00:00"
    day = dt.date(2023, 8, 16)
    assert one(spark, dates.stamp_to_date(F.col("a")), a=good) == day
    assert one(spark, dates.try_stamp_to_date(F.col("a")), a=bad) is None
    assert one(spark, dates.prefix_to_date(F.col("a")), a=good) == day
    with pytest.raises(Exception):
        one(spark, dates.stamp_to_date(F.col("a")), a=bad)


def test_portal_and_link(spark):
    portal = text.portal_of_link(F.col("a"))
    assert one(spark, portal, a="https://www.clarin.com/x") == "clarin"
    assert one(spark, portal, a="https://tn.com.ar/") is None
    assert one(spark, text.drop_www_prefix(F.col("a")), a="https://www.a.b/https://www.c") == (
        "a.b/https://www.c"
    )
    assert one(spark, text.hyperlink(F.col("a")), a="u") == "\\href{u}{link}"


def test_slices(spark):
    assert one(spark, text.slices(F.col("a"), 3), a="abcdefgh") == ["abc", "def", "gh"]
    assert one(spark, text.slices(F.col("a"), 3), a="") == []


def test_authors(spark):
    split = F.array_remove(F.split("a", ","), "")
    assert one(spark, text.join_authors(split), a="x,y") == "x-y"
    assert one(spark, text.join_authors(split), a="") == "n-a"
    assert one(spark, text.text_or_default(F.col("a")), a="") == "na"


# Worked through by hand with the rules of the algorithm; not taken from a test vocabulary.
STEMS = {
    "chicas": "chic",
    "chicharrones": "chicharron",
    "torear": "tor",
    "torneado": "torn",
    "cheques": "chequ",
    "universidades": "univers",
    "rápidamente": "rapid",
    "tecnología": "tecnolog",
    "evolución": "evolu",
    "existencia": "existent",
    "contribuyendo": "contribu",
    "comprándoselas": "compr",
    "paguen": "pag",
    "narcos": "narc",
    "a": "a",
    "sí": "si",
}


def test_stems(spark):
    df = spark.createDataFrame(list(STEMS.items()), "word string, want string")
    wrong = df.withColumn("got", spanish_stem(F.col("word"))).filter("got <> want").collect()
    assert wrong == []


def test_stem_and_folded_word_begin_alike(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = docs.select(F.explode(text.words(F.col("text"), fold=True)).alias("w"))
    short = [a + b + c for a in "abeg" for b in "aeglu" for c in ("en", "amente", "uen", "as", "e", "gue")]
    vocabulary = found.union(spark.createDataFrame([(w,) for w in short], "w string")).distinct()
    stems = vocabulary.select("w", F.substring(spanish_stem(F.col("w")), 1, 3).alias("s"))
    assert stems.filter(~F.startswith("w", "s")).count() == 0


def test_paragraph_text(spark):
    page = (
        "<style>p{}</style><p>a &amp;&lt;b&gt; &#225;&aacute;&bogus; x&y &#x41;<p>c <b>d</b></p>out"
        "<!-- <p>no</p> --><script>t='</p><p>no'</script><div><p>e</div>out<P class='k'>f<ul>out"
    )
    assert one(spark, html.paragraph_text(F.col("a")), a=page) == "a &<b> áá&bogus; x&y A c d e f"
    assert one(spark, html.paragraph_text(F.col("a")), a="plain") == ""


def test_article_links(spark):
    links = html.article_links(F.col("u"), F.col("h"))
    page = '<a href="/x">1</a><A class=k href=\'y?z=1\'>2</a><a href="//h/w">3</a><a href="http://o/p">4</a><a href="/x">5</a><a href="#top">6</a>'
    got = one(spark, links, u="https://s.org/d/e.html?q=/n/", h=page)
    assert got == ["https://s.org/x", "https://s.org/d/y?z=1", "https://h/w", "http://o/p"]


def test_character_references(spark):
    cases = {
        "&apos;&#39;": "''",
        "&#128;&#x80;&#0;&#xD800;&#99999999999;": "€€\ufffd\ufffd\ufffd",
        "a &amp b &copy2024 &notit; &notin; &bogus;": "a & b ©2024 ¬it; ∉ &bogus;",
        "&amp;lt; &NotEqualTilde; &": "&lt; ≂̸ &",
    }
    for given, want in cases.items():
        assert one(spark, html.unescape(F.col("a")), a=given) == want
    assert one(spark, html.unescape(F.col("a"), True), a="?a=1&copy=2&amp;b=3&lt") == "?a=1&copy=2&b=3<"


LINKS = {
    '<!-- <a href="/no">x</a> --><script>t=\'<a href="/no">\'</script><a href="/yes">y</a>': ["https://s.org/yes"],
    "<a href=/x>1</a><a class=k href=y/z title=t>2</a>": ["https://s.org/x", "https://s.org/d/y/z"],
    '<a href="/x?a=1&amp;b=2">1</a>': ["https://s.org/x?a=1&b=2"],
    '<a href="?page=2">1</a>': ["https://s.org/d/e.html?page=2"],
    '<a href="../up">1</a><a href="../../../top/">2</a><a href="./a/./b/..">3</a>': [
        "https://s.org/up", "https://s.org/top/", "https://s.org/d/a/"],
    '<a href="mailto:a@b.c">1</a><a href="javascript:void(0)">2</a><a href=" HTTP://o/p ">3</a>': ["HTTP://o/p"],
    '<a data-href="/no" href="/yes">1</a><a name=k>2</a>': ["https://s.org/yes"],
}


def test_link_forms(spark):
    links = html.article_links(F.col("u"), F.col("h"))
    for page, want in LINKS.items():
        assert one(spark, links, u="https://s.org/d/e.html?q=/n/", h=page) == want


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    rows = df.select(unit(F.col("a")).alias("u"), cosine(F.col("a"), F.col("b")).alias("c")).collect()
    assert rows[0]["u"] == [0.6, 0.8] and rows[0]["c"] == pytest.approx(0.96)
    assert rows[1]["u"] == [0.0, 0.0] and rows[1]["c"] is None
