"""Boxes on pages: overlap, distance, scaling, and parsing of figure markup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IOU_LEAST = 0.5


def iou(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Intersection over union of ``(x0, y0, x1, y1)`` boxes; 0 for an empty union."""
    w = F.greatest(F.lit(0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    inter = (w * h).cast("double")
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
    return F.when(union > 0, inter / union).otherwise(0.0)


def distance(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Distance of the boxes' centres."""
    dx, dy = (a[0] + a[2] - b[0] - b[2]) / 2, (a[1] + a[3] - b[1] - b[3]) / 2
    return F.sqrt(dx * dx + dy * dy)


def to_pixels(box: Column, width: Column, height: Column) -> Column:
    """A ``[y0, x0, y1, x1]`` box in thousandths as pixels ``[x0, y0, x1, y1]``; null for inverted boxes."""
    y0, x0, y1, x1 = (box[k] for k in range(4))
    scaled = F.array(x0 * width / 1000, y0 * height / 1000, x1 * width / 1000, y1 * height / 1000)
    return F.when((x1 > x0) & (y1 > y0), scaled)


def figures(c: Column) -> Column:
    """Figure elements of a text as ``html, bbox, caption, page`` (page from 0); bbox is null where it is missing."""
    found = F.regexp_extract_all(c, F.lit(r"(?s)(<figure.*?</figure>)"), F.lit(1))
    return F.transform(found, lambda f: F.struct(
        f.alias("html"), F.from_json(F.regexp_extract(f, r'data-bbox="(\[[^"]*\])"', 1), "array<double>").alias("bbox"),
        F.nullif(F.trim(F.regexp_extract(f, r"(?s)<figcaption[^>]*>(.*?)</figcaption>", 1)), F.lit("")).alias("caption"),
        (F.nullif(F.regexp_extract(f, r'data-page="(\d{1,9})"', 1), F.lit("")).cast("int") - 1).alias("page"),
    ))


def incomplete_figures(c: Column) -> Column:
    """Whether some figure lacks its box or page."""
    return F.exists(F.regexp_extract_all(c, F.lit(r"(<figure[^>]*>)"), F.lit(1)), lambda t: ~(t.contains("data-bbox=") & t.contains("data-page=")))


def splice(text: Column, pairs: Column) -> Column:
    """Replaces each pair's ``html`` by its ``replacement`` everywhere in the text."""
    return F.aggregate(pairs, text, lambda t, p: F.replace(t, p["html"], p["replacement"]))
