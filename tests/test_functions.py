"""Scalar functions on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docketlake.functions import dates as D
from docketlake.functions import text as T
from docketlake.functions.urls import joined_url


def values(spark, rows, function):
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    return [r[0] for r in df.select(function(F.col("x")).alias("y")).collect()]


def test_white_space_is_unicode(spark):
    assert values(spark, [" a  b\x1c", None, "   "], T.collapse) == ["a b", None, ""]
    assert values(spark, [" a b\x1f", ""], T.strip) == ["a b", ""]
    assert values(spark, [None, " ", "x"], T.blank) == [True, True, False]
    assert values(spark, [None, " a  b "], T.clean) == ["", "a b"]


def test_transliterate(spark):
    assert values(spark, ["Жук", "щи", "ь", "Ёж-A", None, "АМВРОСИЕВСКИЙ"], T.transliterate) == ["Zhuk", "shchi", "", "Ezh-A", None, "AMVROSIEVSKII"]
    assert values(spark, ["Амвросиевский районный суд", "", "12 суд", None], T.court_name) == ["Amvrosievskii", "UnknownCourt", "12_sud", "UnknownCourt"]


def test_file_names(spark):
    assert values(spark, ["2-5/2026 ~ М-4/2026", "///", "x" * 70, None], T.safe_file_stem) == ["2-5_2026_М-4_2026", "case", "x" * 60, "case"]
    assert values(spark, ["a/b.txt", "a.b/c", "c.d.txt"], T.with_stem_suffix) == ["a/b_EN.txt", "a.b/c_EN", "c.d_EN.txt"]


@pytest.mark.parametrize(
    ("text", "needed"),
    [("Иск", True), ("abc", False), ("http://я.рф", False), ("01.02.2025", False), ("12:30", False), ("12-3", False), (" ", False), (None, False), ("01.02.2025 г", True)],
)
def test_needs_translation(spark, text, needed):
    assert values(spark, [text], T.needs_translation) == [needed]


def test_untranslated(spark):
    assert values(spark, ["", "абв", "abcdефg", "abcdefgh", None], T.looks_untranslated) == [False, True, False, False, False]
    assert values(spark, ["abc ", " иск  мой", None], T.passthrough_norm) == [None, "иск мой", None]


def test_pages_in_urls(spark):
    given = ["http://c/?a=%CE&page=1&page=2", "http://c/?a=1", "http://c/", "http://c/?page="]
    assert values(spark, given, lambda c: T.set_page(c, F.lit(7))) == ["http://c/?a=%CE&page=7&page=2", "http://c/?a=1&page=7", "http://c/?page=7", "http://c/?page=7"]
    assert values(spark, ["https://a.b/c/d?e"], T.three_segments) == ["https://a.b/"]


def test_inline_and_marker(spark):
    path = F.lit("p.txt")
    assert values(spark, ["a" * 12], lambda c: T.inline(c, path, limit=10, kept=5)) == ["[TRUNCATED -- full text in p.txt]\naaaaa"]
    assert values(spark, ["[TRUNCATED -- x]\nabc", "abc", " a "], T.without_marker) == ["abc", "abc", "a"]


def test_labels(spark):
    df = spark.createDataFrame([("Role", "Name"), ("Same", "Same"), ("", "N"), ("R", None), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(T.labelled_entry(F.col("a"), F.col("b"))).collect()] == ["Role: Name", "Same", "N", "R", ""]
    assert values(spark, ["Case joined to another case", "Other", None], T.shorten) == ["Joined to another case", "Other", None]
    assert values(spark, [None, " ", " a "], lambda c: T.label_blank(c, "none")) == ["none", "none", "a"]


def test_dates(spark):
    day = dt.date(2025, 2, 1)
    assert values(spark, ["01.02.2025", "1.2.2025", "31.02.2025", "nan", "", None, "2025-02-01", " 01.02.2025 "], D.parse_strict) == [day, day, None, None, None, None, None, day]
    flexible = ["1/2/2025", "2025-02-01", "1-2-2025", "1 Feb 2025", "01.02.2025 9:30", "soon", "NaT", "1.2.25"]
    assert values(spark, flexible, D.parse_flexible) == [day, day, day, day, day, None, None, day]
    assert values(spark, ["5.2.2025"], lambda c: D.month_of(D.parse_strict(c))) == [day]
    assert values(spark, ["5.2.2025", None], lambda c: D.day_text(D.parse_strict(c))) == ["05.02.2025", None]
    assert values(spark, ["5.2.2025"], lambda c: D.month_label(D.parse_strict(c))) == ["Feb 2025"]


def test_numbers(spark):
    assert [r[0] for r in spark.range(1).select(F.explode(F.array(*[D.pages_of(F.lit(n)) for n in (0, 25, 26, 228)]))).collect()] == [1, 1, 2, 10]
    row = spark.range(1).select(D.per_10k(F.lit(30), F.lit(25000)).alias("a"), D.per_10k(F.lit(30), F.lit(0)).alias("b"), D.scaled(F.lit(5), F.lit(10), 0.25, 1.0).alias("c")).first()
    assert (row.a, row.b, row.c) == (12.0, None, 0.625)


def test_one_decimal_rounds_the_binary_number(spark):
    """As C does: ties to even, and 0.35, which is a little less, down. Java's format gives 4698.3, 0.3 and 0.4."""
    given = [4698.25, 0.25, 0.75, 0.35, 0.45, -0.25, 12.0, 1234567.05, None]
    got = [r.y for r in spark.createDataFrame([(x,) for x in given], "x double").select(D.one_decimal(F.col("x")).alias("y")).collect()]
    assert got == ["4698.2", "0.2", "0.8", "0.3", "0.5", "-0.2", "12.0", "1234567.1", None]


def test_joined_url(spark):
    """RFC 3986, 5.4, and addresses of the kind that pages have."""
    base = "http://a/b/c/d;p?q"
    cases = {
        "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y",
        "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s", ";x": "http://a/b/c/;x", "": "http://a/b/c/d;p?q", ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g",
        "../..": "http://a/", "../../": "http://a/", "../../g": "http://a/g", "../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.", "..g": "http://a/b/c/..g", "./../g": "http://a/b/g",
        "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g;x=1/../y": "http://a/b/c/y", "g?y/../x": "http://a/b/c/g?y/../x", "http://e/x/../y": "http://e/y",
    }
    rows = [(base, r) for r in cases] + [("http://a", "g"), ("http://a?x", "g?y"), (None, "g"), (base, None)]
    got = [r[0] for r in spark.createDataFrame(rows, "base string, ref string").select(joined_url(F.col("base"), F.col("ref"))).collect()]
    assert got == [*cases.values(), "http://a/g", "http://a/g?y", None, None]
