"""Literal cases of the column functions."""

import pytest
from pyspark.sql import functions as F

from varak.functions import geo, meta, udf
from varak.functions import text as T
from varak.operators import assemble, catalog
from varak.sources import files


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'binary' if isinstance(v, bytes) else 'string'}" for k, v in values.items()))
    return df.select(column).first()[0]


@pytest.mark.parametrize(("fn", "given", "want"), [
    (T.dehyphenate, "мәдә-\nният", "мәдәният"),
    (lambda c: T.dashes(T.dehyphenate(c)), "- a\n-b", "— a\n— b"),
    (T.dashes, "x - q", "x - q"),
    (T.cap_underscores, "_" * 11, "_" * 10), (T.cap_underscores, "_" * 10, "_" * 10),
    (T.headers, "## A b\n### C\n# no\n####### x", ["## A b", "### C"]),
    (T.footnotes, "[^3]: a [^12]: b", [3, 12]), (T.max_footnote, "none", 0),
    (T.trim_tail, "ab-", "ab"), (T.trim_tail, "ab\n", "ab"), (T.trim_tail, "ab\n-", "ab"), (T.trim_tail, "ab-\n", "ab-"),
    (T.unescape, "a\\_b\\<c", "a_b<c"),
    (T.strip_images, "![](a.png) x ![k](b.png) y", "x  y"),
    (T.toc_marker, '<table class="toc"><tr>\n</tr></table>z', "<!-- mdformat-toc start --no-anchors -->z"),
    (T.markdown, "a\r\n\r\n\r\n\r\nb\n\n", "a\n\nb\n"),
    (catalog.isbn_key, " b, a,,c ", "a, b, c"), (catalog.isbn_key, "", ""),
    (catalog.nontarget_place, "tt-Cyrl, ru-Cyrl", "nontatar/ru-Cyrl-tt-Cyrl"),
    (udf.sentences, "Бер. Ике! өч дүрт", ["Бер.", "Ике! өч дүрт"]),
    (udf.html_to_markdown, '<h2>A</h2><p>b\n<b>c</b> <a href="x.html">d</a> <a href="http://e">f</a></p>', "## A\n\nb **c** d [f](http://e)"),
])
def test_text(spark, fn, given, want):
    assert one(spark, fn(F.col("a")), a=given) == want


@pytest.mark.parametrize(("tail", "text", "want"), [("сүз", "дәвам.", " "), ("сүз-", "дәвам", ""), ("Тәмам.", "Яңа", "\n\n"), ("сүз", "## X", "\n\n"), ("сүз", "", ""), ("", "Яңа", "\n\n")])
def test_glue(spark, tail, text, want):
    assert one(spark, T.glue(F.col("a"), F.col("b")), a=tail, b=text) == want


def test_boxes(spark):
    box = lambda *v: tuple(F.lit(float(x)) for x in v)
    df = spark.range(1)
    got = df.select(geo.iou(box(0, 0, 2, 2), box(0, 0, 2, 2)), geo.iou(box(0, 0, 1, 1), box(2, 2, 3, 3)), geo.iou(box(0, 0, 0, 0), box(0, 0, 0, 0)), geo.distance(box(0, 0, 2, 2), box(3, 4, 5, 6))).first()
    assert tuple(got) == (1.0, 0.0, 0.0, 5.0)
    px = df.select(geo.to_pixels(F.array(*map(F.lit, (100.0, 150.0, 300.0, 450.0))), F.lit(1000), F.lit(2000))).first()[0]
    assert px == [150.0, 200.0, 450.0, 600.0]


def test_meta(spark):
    text = '{"name": "Unknown", "author": [{"name": "A"}, {"name": "unknown"}], "inLanguage": "tt-Cyrl, ,ru-Cyrl", "datePublished": "1999-05-01", "contributor": [{"name": "T", "role": "translator"}], "isbn": ["978-5-91886-001-2"], "genre": ["Fiction", "unknown"], "numberOfPages": 12, "additionalProperty": [{"name": "udc", "value": "82 1"}]}'
    b = F.from_json("a", meta.BOOK)
    row = spark.createDataFrame([(text, 10)], "a string, pages int").select(meta.title(b), meta.author(b), meta.language(b), meta.publish_date(b, F.lit("old")), meta.translated(b), meta.isbn(b), meta.genre(b), meta.page_count(b, F.col("pages")), meta.classification(b, ("UDC",))).first()
    assert tuple(row) == (None, "A", "ru-Cyrl, tt-Cyrl", "1999", True, "9785918860012", "fiction", 12, "821")
    assert one(spark, meta.publish_date(F.from_json("a", meta.BOOK), F.lit("old")), a='{"datePublished": "circa 1980"}') == "old"


def test_half_day(spark):
    df = spark.createDataFrame([("2025-08-11 08:59:00",), ("2025-08-11 09:00:00",)], "t string").select(files.half_day(F.to_timestamp("t")))
    assert [r[0] for r in df.collect()] == ["20250810_1", "20250811_0"]


def test_plans(spark):
    totals = spark.createDataFrame([("a", 12), ("b", 7), ("c", 20)], "md5 string, n_pages int")
    ranges = spark.createDataFrame([("a", 0, 4), ("b", 0, 2), ("b", 1, 2), ("zz", 0, 1)], "md5 string, start_page int, end_page int")
    plan = assemble.gaps(ranges, totals)
    assert sorted(map(tuple, plan.collect())) == [("a", 5, 9), ("a", 10, 11), ("b", 3, 6), ("c", 0, 4), ("c", 5, 9), ("c", 10, 14), ("c", 15, 19)]
    assert sorted(map(tuple, assemble.merged_tail(plan.where("md5 = 'a'")).collect())) == [("a", 5, 11)]
    assert sorted(map(tuple, assemble.page_islands(totals).where("md5 <> 'a'").collect())) == [("b", 0, 6), ("c", 0, 4), ("c", 15, 19)]


def test_footnotes_up(spark):
    assert one(spark, assemble.footnotes_up(F.col("a")), a="one\n\nlast\n\n[^1]: note\n") == "one\n\n[^1]: note\n\n\nlast"


def test_split_document_assembles_to_itself(spark):
    text = "Беренче җөмлә дәвам итә һәм икенче"
    rows = [("a", 0, 4, 1, text[:12]), ("a", 5, 9, 2, text[13:])]
    df = spark.createDataFrame(rows, "md5 string, start_page int, end_page int, chunk_id bigint, content string").withColumn("extracted_at", F.lit(None).cast("timestamp_ntz"))
    assert assemble.documents(assemble.latest(df)).first().text == text[:12] + " " + text[13:]


def test_encoding_and_archives(spark):
    assert one(spark, files.decoded(F.col("a")), a="татар".encode("cp1251")) == "татар"
    assert one(spark, files.unzipped(files.zipped(F.lit("n"), F.col("a"))), a="текст").text == "текст"
    assert one(spark, files.unzipped(F.col("a")), a=b"no archive").error == "BadZipFile"
