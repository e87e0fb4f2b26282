"""Figures of a text matched to detected boxes on its pages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varak.functions import geo

_BOX = ("x0", "y0", "x1", "y1")
#: What an image looks like in a text, round its link and caption (fixed values).
IMAGE = ('<figure style="text-align: center; margin: 1em 0;"><img alt="" src="', '" style="max-width: 800px; width: 50%; height: auto;">', "</figure>\n")


def parsed(texts: DataFrame, key: str = "md5", column: str = "content") -> DataFrame:
    """One row per figure: key, ``figure_no, html, bbox, caption, page, status``."""
    rows = texts.select(key, F.posexplode(geo.figures(F.col(column))).alias("figure_no", "f"))
    status = F.when(F.col("f.bbox").isNull() | F.col("f.page").isNull() | (F.size("f.bbox") != 4), "no_box").otherwise("ok")
    return rows.select(key, "figure_no", "f.html", "f.bbox", "f.caption", "f.page", status.alias("status"))


def candidates(figures: DataFrame, boxes: DataFrame, keys: list[str], width: float = 1000, height: float = 1000) -> DataFrame:
    """Pairs on one page that overlap by more than half, or whose centres are near: keys, ids, ``method, score``.

    Both sides have ``box_id, x0, y0, x1, y1``; the page keys make it an equality join.
    """
    g, y = figures.alias("g"), boxes.alias("y")
    a, b = tuple(F.col(f"g.{c}") for c in _BOX), tuple(F.col(f"y.{c}") for c in _BOX)
    rows = g.join(y, [F.col(f"g.{k}") == F.col(f"y.{k}") for k in keys]).select(*[F.col(f"g.{k}").alias(k) for k in keys], F.col("g.box_id").alias("figure_id"), F.col("y.box_id").alias("detected_id"), geo.iou(a, b).alias("iou"), geo.distance(a, b).alias("distance"))
    method = F.when(F.col("iou") > geo.IOU_LEAST, "iou").when(F.col("distance") < (width + height) / 10, "distance")
    rows = rows.withColumn("method", method).where("method is not null")
    return rows.select(*keys, "figure_id", "detected_id", "method", F.round(F.when(F.col("method") == "iou", F.col("iou")).otherwise(F.col("distance")), 6).alias("score"))


def matches(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Greedy one-to-one matches of each page: overlaps before distances, the best first, ties by ids.

    Candidates of a page come sorted to one task and are taken one after the other, so a page costs its candidates and
    no more memory than its matched ids, however many there are.
    """
    late, cost = F.col("method") != "iou", F.when(F.col("method") == "iou", -F.col("score")).otherwise(F.col("score"))
    ordered = pairs.withColumns({"late": late, "cost": cost}).repartition(*keys).sortWithinPartitions(*keys, "late", "cost", "figure_id", "detected_id")
    names = [*keys, "figure_id", "detected_id", "method", "score"]
    schema = ", ".join(f"`{c}` {pairs.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        page, figures, boxes = None, set(), set()
        for pdf in batches:
            keep = []
            for row in pdf[names].itertuples(index=False, name=None):
                if row[: len(keys)] != page:
                    page, figures, boxes = row[: len(keys)], set(), set()
                f, b = row[len(keys) : len(keys) + 2]
                keep.append(free := f not in figures and b not in boxes)
                if free:
                    figures.add(f)
                    boxes.add(b)
            yield pdf.loc[keep, names]

    return ordered.select(*names).mapInPandas(run, schema)


def by_page(figures: DataFrame, key: str = "md5") -> DataFrame:
    """Figures of each page in reading order: key, ``page, figures``."""
    one = F.struct("figure_no", "html", "bbox", "caption")
    return figures.where("page is not null").groupBy(key, "page").agg(F.array_sort(F.collect_list(one)).alias("figures"))


def clip_order(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """Boxes of each page numbered from 0 by their left, then their upper edge."""
    return boxes.withColumn("clip_no", F.row_number().over(Window.partitionBy(*keys).orderBy("x0", "y0", "box_id")) - 1)


def replacements(figures: DataFrame, matched: DataFrame, keys: list[str]) -> DataFrame:
    """Every figure with what stands in its place: an image where a box was matched, else nothing.

    ``figures`` has the keys, ``figure_id, html, caption``; ``matched`` the keys, ``figure_id, url``.
    """
    rows = figures.join(matched.select(*keys, "figure_id", "url"), [*keys, "figure_id"], "left")
    caption = F.when(F.coalesce("caption", F.lit("")) != "", F.concat(F.lit("<figcaption>"), "caption", F.lit("</figcaption>"))).otherwise("")
    image = F.concat(F.lit(IMAGE[0]), "url", F.lit(IMAGE[1]), caption, F.lit(IMAGE[2]))
    return rows.withColumn("replacement", F.coalesce(image, F.lit("")))


def detections(boxes: DataFrame, kind: str = "picture") -> DataFrame:
    """Detected boxes of one class in lower case, their confidence as text with two digits at most."""
    return boxes.withColumn("class", F.lower("class")).where(F.col("class") == kind).withColumn("conf", F.round("conf", 2).cast("string"))


def layout_records(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """One record for each page: keys, ``w, h, layouts`` with the boxes in their order."""
    one = F.struct("box_id", F.array("x0", "y0", "x1", "y1").alias("bbox"), F.lower("class").alias("class"), F.round("conf", 2).cast("string").alias("conf"))
    return boxes.groupBy(*keys).agg(F.max("w").alias("w"), F.max("h").alias("h"), F.array_sort(F.collect_list(one)).alias("layouts"))


def rescaled(records: DataFrame, keys: list[str], width: Column, height: Column) -> DataFrame:
    """Boxes of layout records in the space of a page of ``width`` by ``height``: keys, ``box_id, class, conf, x0..y1``."""
    rows = records.select(*keys, "w", "h", width.alias("pw"), height.alias("ph"), F.explode("layouts").alias("l"))
    at = [(F.col("l.bbox")[k] * F.col("pw" if k % 2 == 0 else "ph") / F.col("w" if k % 2 == 0 else "h")).alias(c) for k, c in enumerate(_BOX)]
    return rows.select(*keys, "l.box_id", "l.class", "l.conf", *at)


def replaced(texts: DataFrame, pairs: DataFrame, key: str = "md5", column: str = "content") -> DataFrame:
    """Texts with each figure's ``html`` replaced by its ``replacement``; texts without pairs stay."""
    lists = pairs.groupBy(key).agg(F.collect_list(F.struct("html", F.coalesce("replacement", F.lit("")).alias("replacement"))).alias("pairs"))
    rows = texts.join(lists, key, "left")
    return rows.select(key, F.when(F.col("pairs").isNull(), F.col(column)).otherwise(geo.splice(F.col(column), F.col("pairs"))).alias(column))
