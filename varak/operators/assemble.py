"""Ordered page chunks of a record: planning, running state, assembly.

A record's chunks are a window partition. Windows keep only numbers, headings and tails, a few hundred bytes a chunk;
texts stay out of them and are put together in parts of bounded size, so a record of any length is never one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varak.functions import text as T

TAIL = 300


def latest(chunks: DataFrame) -> DataFrame:
    """Each page range once, the latest extraction winning; chunks without content are left out.

    The winners are chosen on narrow columns, so texts are shuffled once at most.
    """
    rows = chunks.where("content is not null and start_page is not null and end_page is not null")
    order = F.struct(F.coalesce("extracted_at", F.lit("0001-01-01").cast("timestamp_ntz")), "chunk_id")
    best = rows.groupBy("md5", "start_page", "end_page").agg(F.max_by("chunk_id", order).alias("chunk_id"))
    return rows.select("md5", "start_page", "end_page", "chunk_id", "content").join(best.select("chunk_id"), "chunk_id", "left_semi")


def _before() -> Window:
    return Window.partitionBy("md5").orderBy("start_page", "end_page").rowsBetween(Window.unboundedPreceding, -1)


def next_footnotes(chunks: DataFrame) -> DataFrame:
    """The number with which each chunk's footnotes may begin."""
    rows = chunks.select("md5", "start_page", "end_page", T.max_footnote(F.col("content")).alias("last"))
    return rows.select("md5", "start_page", "end_page", F.greatest(F.lit(1), F.coalesce(F.max("last").over(_before()), F.lit(0)) + 1).alias("next_footnote"))


def header_hierarchy(chunks: DataFrame) -> DataFrame:
    """Headings of the chunks before each chunk, in order."""
    rows = chunks.select("md5", "start_page", "end_page", T.headers(F.col("content")).alias("own"))
    return rows.select("md5", "start_page", "end_page", F.array_join(F.flatten(F.collect_list("own").over(_before())), "\n").alias("hierarchy"))


PART = 64 * 1024 * 1024


def glues(chunks: DataFrame) -> DataFrame:
    """``md5, start_page, end_page, chunk_id, glue, size``: what stands before each chunk, and its characters."""
    w = Window.partitionBy("md5").orderBy("start_page", "end_page")
    content = F.col("content")
    rows = chunks.select("md5", "start_page", "end_page", "chunk_id", F.right(content, F.lit(TAIL)).alias("own"), T.new_block(content).alias("block"), F.length(content).cast("bigint").alias("size"))
    rows = rows.withColumns({"tail": F.lag("own").over(w), "first": F.row_number().over(w) == 1})
    glue = F.when(F.col("first") | (F.col("size") == 0), F.lit("")).otherwise(T.glue_to(F.col("tail"), F.col("block")))
    return rows.select("md5", "start_page", "end_page", "chunk_id", glue.alias("glue"), "size")


def document_parts(chunks: DataFrame, size: int = PART) -> DataFrame:
    """``md5, part_no, text, n_chunks``: the record's text in page order as parts, with words over chunk ends joined.

    A part is closed by the chunk that reaches ``size`` characters; the parts of a record one after the other are its
    text. No task holds more of a record than one part and the narrow rows of its chunks.
    """
    w = Window.partitionBy("md5").orderBy("start_page", "end_page").rowsBetween(Window.unboundedPreceding, -1)
    placed = glues(chunks).withColumn("part_no", F.floor(F.coalesce(F.sum("size").over(w), F.lit(0)) / size).cast("int"))
    rows = chunks.select("chunk_id", "content").join(placed, "chunk_id")
    piece = F.struct("start_page", "end_page", F.concat("glue", T.trim_tail(F.col("content"))).alias("piece"))
    one = rows.groupBy("md5", "part_no").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    return one.select("md5", "part_no", F.array_join("pieces.piece", "").alias("text"), F.size("pieces").alias("n_chunks"))


def documents(chunks: DataFrame) -> DataFrame:
    """``md5, text, n_chunks``: each record's text as one value, for records below Spark's 2 GB of a value."""
    parts = document_parts(chunks).groupBy("md5").agg(F.array_sort(F.collect_list(F.struct("part_no", "text"))).alias("p"), F.sum("n_chunks").cast("int").alias("n_chunks"))
    return parts.select("md5", F.array_join("p.text", "").alias("text"), "n_chunks")


def gaps(ranges: DataFrame, totals: DataFrame, size: int = 5) -> DataFrame:
    """``md5, start_page, end_page``: chunks of at most ``size`` pages that fill what is not covered yet.

    Pages count from 0 to ``n_pages`` - 1. Overlapping and nested ranges are covered; a record without any range is
    planned whole. A column ``size`` of ``totals`` goes before the parameter: that is how failed chunks are planned again
    with the next smaller size (see ``triage``).
    """
    sizes = totals.select("md5", F.col("size") if "size" in totals.columns else F.lit(size).alias("size"))
    ends = totals.select("md5", F.col("n_pages").alias("start_page"), F.col("n_pages").alias("end_page"))
    rows = ranges.join(totals, "md5", "left_semi").select("md5", "start_page", "end_page").unionByName(ends)
    w = Window.partitionBy("md5").orderBy("start_page", "end_page").rowsBetween(Window.unboundedPreceding, -1)
    free = rows.withColumn("from", F.coalesce(F.max("end_page").over(w) + 1, F.lit(0))).where(F.col("from") < F.col("start_page"))
    free = free.join(sizes, "md5") if "size" in totals.columns else free.withColumn("size", F.lit(size))
    starts = free.select("md5", "size", F.explode(F.sequence("from", F.col("start_page") - 1, F.col("size"))).alias("s"), (F.col("start_page") - 1).alias("last"))
    return starts.select("md5", F.col("s").alias("start_page"), F.least(F.col("s") + F.col("size") - 1, "last").alias("end_page"))


def merged_tail(plan: DataFrame, least: int = 5) -> DataFrame:
    """The plan with a record's last chunk joined to the one before when it is too short and adjoins it."""
    w = Window.partitionBy("md5").orderBy("start_page")
    rows = plan.withColumns({"nxt": F.lead("end_page").over(w), "nxt_start": F.lead("start_page").over(w), "after": F.lead("end_page", 2).over(w), "prv_end": F.lag("end_page").over(w), "is_last": F.lead("end_page").over(w).isNull()})
    short = F.col("is_last") & (F.col("end_page") - F.col("start_page") + 1 < least) & (F.col("prv_end") + 1 == F.col("start_page"))
    takes = F.col("after").isNull() & F.col("nxt").isNotNull() & (F.col("nxt") - F.col("nxt_start") + 1 < least) & (F.col("end_page") + 1 == F.col("nxt_start"))
    return rows.where(~F.coalesce(short, F.lit(False))).select("md5", "start_page", F.when(F.coalesce(takes, F.lit(False)), F.col("nxt")).otherwise(F.col("end_page")).alias("end_page"))


def uncovered_pages(ranges: DataFrame, totals: DataFrame) -> DataFrame:
    """Pages that no range covers: ``md5, page``."""
    return gaps(ranges, totals, 1).select("md5", F.col("start_page").alias("page"))


def page_islands(totals: DataFrame, n: int = 5) -> DataFrame:
    """The first and last ``n`` pages of each record as contiguous ranges."""
    head = F.struct(F.lit(0).alias("start_page"), (F.least(F.lit(n), "n_pages") - 1).alias("end_page"))
    tail = F.struct((F.col("n_pages") - n).alias("start_page"), (F.col("n_pages") - 1).alias("end_page"))
    whole = F.struct(F.lit(0).alias("start_page"), (F.col("n_pages") - 1).alias("end_page"))
    rows = totals.where("n_pages > 0").select("md5", F.explode(F.when(F.col("n_pages") <= 2 * n, F.array(whole)).otherwise(F.array(head, tail))).alias("r"))
    return rows.select("md5", "r.start_page", "r.end_page")


def footnotes_up(c: Column) -> Column:
    """Moves footnotes that end a text above its last paragraph."""
    return F.regexp_replace(c, r"(?s)\A(.*?)((?:\A|\n\n)(?!\[\^)[^\n]+(?:\n(?!\[\^|\n)[^\n]+)*)\n\n((?:\[\^\d+\]:[^\n]*\n?)+)\z", "$1\n\n$3$2")
