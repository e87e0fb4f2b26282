"""Requests to a reading model as ordered parts; the wording is data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Wording of each part; ``{first}``, ``{last}``, ``{footnote}`` and ``{headings}`` are filled in.
PARTS = {
    "prelude": "Read pages {first} to {last}. Headings so far: {headings}", "body": "Pages count from {first}.", "footnotes": "Footnotes begin at {footnote}.",
    "title": "The first page may hold a title.", "no_title": "No title stands here. Headings so far: {headings}", "final": "Give the text as JSON.",
}


def filled(template: str, values: dict[str, Column]) -> Column:
    out: Column = F.lit(template)
    for k, v in values.items():
        out = F.replace(out, F.lit("{" + k + "}"), F.coalesce(v.cast("string"), F.lit("")))
    return out


def parts(chunks: DataFrame, examples: Column | None = None, wording: dict[str, str] = PARTS) -> DataFrame:
    """``md5, start_page, end_page, part_no, text`` of each chunk's request, in order.

    ``chunks`` has ``md5, start_page, end_page, next_footnote, hierarchy``. Only the chunk that begins at page 0 may hold
    a title; ``examples``, an array, stand before the last part.
    """
    values = {"first": F.col("start_page"), "last": F.col("end_page"), "footnote": F.col("next_footnote"), "headings": F.col("hierarchy")}
    title = F.when(F.col("start_page") == 0, filled(wording["title"], values)).otherwise(filled(wording["no_title"], values))
    head = F.array(*[filled(wording[k], values) for k in ("prelude", "body", "footnotes")], title)
    whole = F.concat(head, examples if examples is not None else F.array().cast("array<string>"), F.array(filled(wording["final"], values)))
    rows = chunks.select("md5", "start_page", "end_page", F.posexplode(whole).alias("part_no", "text"))
    return rows.withColumn("part_no", F.col("part_no") + 1)


def example_pairs(files: DataFrame) -> DataFrame:
    """``example_no, image, text`` of few-shot examples: ``x1.jpeg`` belongs to the ``.md`` file of the same stem.

    The stem is a text's name without its last character; examples count in the order of the texts' names, which are few.
    """
    from pyspark.sql import Window

    named = files.select("name", F.regexp_extract("name", r"^(.+)\.[^.]+$", 1).alias("stem"))
    texts = named.where(F.col("name").endswith(".md")).select(F.col("name").alias("text"), F.expr("concat(left(stem, length(stem) - 1), '1.jpeg')").alias("image"))
    images = named.where(F.col("name").endswith(".jpeg")).select(F.col("name").alias("image"))
    return texts.join(images, "image").select(F.row_number().over(Window.orderBy("text")).alias("example_no"), "image", "text")
