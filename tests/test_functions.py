"""Scalar functions on exact pairs, and edge cases of the model's rules."""

import time

import pytest
from pyspark.sql import functions as F

from lorekeeper.functions import text as t
from lorekeeper.functions.html import text_of
from lorekeeper.operators import periods


def one(spark, column, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(column).collect()]


def test_white_space(spark):
    assert one(spark, t.collapsed(F.col("v")), "  Yowie\n\n  Bay\tnoise  ", "a  b", None) == ["Yowie Bay noise", "a b", ""]


def test_normalised(spark):
    assert one(spark, t.normalised(F.col("v")), "  “Hairy Man”  ", "YARA-MA-YHA-WHO", "ﬁn Straße") == ['"hairy man"', "yara-ma-yha-who", "fin strasse"]


def test_slug(spark):
    assert one(spark, t.slug(F.col("v")), "Hairy Man of the Wood!", "Café  Ñandú", "!!!", None) == ["hairy-man-of-the-wood", "cafe-nandu", "item", "item"]


def test_years(spark):
    assert one(spark, periods.year_in(F.col("v")), "12 March 1897", "c. 1974", "", "12345", None) == [1897, 1974, None, None, None]
    assert one(spark, periods.leading_year(F.col("v")), " 1999-01", "c. 1999", None) == [1999, None, None]


def test_canonical_url(spark):
    urls = "HTTPS://WWW.Example.org/a/b/?utm_source=x&id=2&fbclid=1#top", "example.org/", "http://example.org/?ref=1"
    assert one(spark, t.canonical_url(F.col("v")), *urls) == ["https://example.org/a/b?id=2", "https://example.org/", "http://example.org/?ref=1"]


def test_bands(spark):
    bands = [("a", 1990, 1994), ("b", 1995, 1999)]
    years = spark.createDataFrame([(None,), (1990,), (1994,), (1995,), (2000,)], "y int")
    assert [r[0] for r in years.select(periods.band_of(F.col("y"), bands)).collect()] == ["undated", "a", "a", "b", "outside_scope"]
    records = spark.createDataFrame([(1, 1990), (2, None)], "record_id long, year int")
    rows = {r.band: r for r in periods.band_summary(records, records.where("record_id = 1"), bands).collect()}
    assert rows["b"].records == 0 and rows["b"].mapped_share == 0 and rows["a"].mapped_share == 1 and rows["undated"].records == 1


def test_interval_without_end(spark):
    spans = spark.createDataFrame([(1, 1991, None), (2, 1991, 9999), (3, None, 1999)], "id int, y1 int, y2 int")
    bands = spark.createDataFrame([("a", 1990, 1994), ("b", 1995, 1999)], "band string, first_year int, last_year int")
    got = sorted((r.id, r.band) for r in periods.interval_overlaps(spans, bands, "y1", "y2").collect())
    assert got == [(1, "a"), (2, "a"), (2, "b")]


def test_visible_text():
    assert text_of("<p>a&amp;b<script>x</script></p><p>c <b>d</b></p>") == "a&b c d"


@pytest.mark.parametrize("other, low, high", [("Yowie in Queensland", 0.7, 1.0), ("", 0.0, 0.0)])
def test_token_overlap(spark, other, low, high):
    df = spark.createDataFrame([("The Yowie in Queensland", other)], "a string, b string")
    assert low <= df.select(t.jaccard(t.title_tokens(F.col("a")), t.title_tokens(F.col("b")))).first()[0] <= high


def test_reference_forms_of_texts(spark):
    assert one(spark, t.normalised(F.col("v")), "A\ufe58B", "\u201eX\u201d", "STRASSE \u00df") == ["a-b", "\u201ex\"", "strasse ss"]
    assert one(spark, t.slug(F.col("v")), "\u014ctautahi", "Stra\u00dfe", "\ufb01n") == ["otautahi", "strasse", "fin"]
    assert one(spark, t.slug(F.col("v"), max_length=6), "abcde fgh", "ab") == ["abcde", "ab"]
    assert one(spark, t.canonical_url(F.col("v")), "http://Example.org:8080/a//", "http://www.x.org", "http://x.org//", "http://x.org/?q=a b&e&utm_term=1&x=%7e%2A", None, "") == ["http://example.org:8080/a", "http://x.org", "http://x.org//", "http://x.org/?q=a+b&e=&x=~%2A", "", ""]
    assert one(spark, t.strip_tags(F.col("v")), "<td>a</td><td>b</td>", "<p>x</p><script>no</script>\n<p> y&amp;z </p>") == ["a b", "x\ny&z"]
    assert one(spark, t.evidence_hash(F.col("v")), " A  b ") == one(spark, F.sha2(F.lit("a b"), 256), "")


def test_parts_of_texts(spark):
    assert one(spark, t.cropped(F.col("v"), "START", "end"), "x start y END z", "end start y", "none") == ["start y ", "start y", "none"]
    assert one(spark, t.sentence_around(F.col("v"), "Ghost"), "One. A  ghost was seen here! Two.", "nothing") == ["A ghost was seen here!", "nothing"]
    places = spark.createDataFrame([("Ballarat Gold (1890) Victoria 1901 - notes", "Victoria"), ("Bega, NSW", "NSW"), ("(1999)", ""), ("Victoria", "Victoria"), ("Tom &amp; Co : x", None)], "v string, s string")
    assert [r[0] for r in places.select(t.place_of(F.col("v"), F.col("s"))).collect()] == ["Ballarat Gold", "Bega", "Australia", "Victoria", "Tom & Co"]
    coded = spark.createDataFrame([("Bega (NSW) 1999 - a note", "New South Wales", "NSW"), ("Bega, nsw", "New South Wales", "NSW"), ("Ghosts of the Gap, Queensland", "Queensland", "QLD"), ("the gap QLD", "Queensland", "QLD"), ("The Gap, NSW", "New South Wales", "NSW"), ("- Bega. - x", "", ""), ("1999", "Victoria", "VIC"), ("Foo :bar", None, None)], "v string, s string, c string")
    hints = [("gap", "QLD", "Gap Creek"), ("the gap", "QLD", "The Gap")]
    assert [r[0] for r in coded.select(t.place_of(F.col("v"), F.col("s"), F.col("c"), hints)).collect()] == ["Bega", "Bega", "The Gap", "The Gap", "The Gap", "Bega", "Victoria", "Foo"]
    found = one(spark, t.place_state_year(F.col("v"), {"Victoria": "VIC", "New South Wales": "NSW"}, ("news",)), "Bega, new south wales 1999", "Ararat, VIC 2001", "Daily News, VIC 2001", "Bega 1999", None)
    assert [tuple(x) if x else None for x in found] == [("Bega", "NSW", 1999), ("Ararat", "VIC", 2001), None, None, None]


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p title=it's>Hello there", "Hello there"), ("<p title='it>s'>a</p><p title=\"x>y\" b=c'>d", "a d"), ("a < b <i>c</i> <3 d", "a < b c <3 d"), ("<p class=\"x>text</p>tail", "text tail"),
        ("<!-- a > b --><p>x<!-- never closed <p>y", "x"), ("<!doctype html><?xml v?><p>x", "x"), ("<script>if (a<b) '</p>'</script>x<style>y", "x"), ("x<script>y", "x"), ("<a href='u>x", "x"), ("end <a href", "end <a href"),
        ("<svg><svg>a</svg>b</svg>c", "c"), ("</noscript>a", "a"), ("a&nbsp;b &lt;i&gt;", "a b <i>"), ("", ""), ("<scripty>x</scripty>", "x"), ("<SCRIPT>x</sCript >y", "y"),
    ],
)
def test_visible_text_of_broken_pages(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize("part", ["<a ", "<a href='", "<a =\">", "<!--", "<p title=it's ", "<div>", "<script>", "</", "<a b=\"<\" c='", "&", "<x>y</x>"])
def test_pages_are_read_in_linear_time(part):
    page = part * (1_000_000 // len(part))
    began = time.perf_counter()
    text_of(page + ">")
    text_of(page)
    assert time.perf_counter() - began < 8


def test_visible_lines(spark):
    from lorekeeper.functions.html import lines_of

    assert lines_of("<p>a <b>b</b></p><table><tr><td>no<table><p>no</table></table>c<br>d<sup>1</sup><script>if (a<b) '</p>'</script> e &amp; f") == "a b\nc\nd e & f"
    assert lines_of("") == "" and lines_of("<nav>no") == ""


def test_texts_by_path(spark, tmp_path):
    from lorekeeper.sources.readers import columns_of, has_table, texts_by_path

    for folder in ("a", "b c"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x+1.txt").write_text(f"text of {folder}")
    paths = spark.createDataFrame([("a/x+1.txt",), ("b c/x+1.txt",), ("x+1.txt",)], "path string")
    assert {tuple(r) for r in texts_by_path(spark, str(tmp_path), paths).collect()} == {("a/x+1.txt", "text of a"), ("b c/x+1.txt", "text of b c"), ("x+1.txt", "")}
    assert columns_of(spark, "/root/testdata/sf0.001", "region") == ["r_regionkey", "r_name"] and not has_table(spark, str(tmp_path), "region")
