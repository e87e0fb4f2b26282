"""Queries of the training-data problems, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varak.llm import langid, leaks, names, packing, pii, scans, subjects, survivors
from varak.sources.tables import table, written


def _t(spark: SparkSession, d: str, *names_: str) -> list[DataFrame]:
    return [table(spark, d, n) for n in names_]


def p2_entities(spark: SparkSession, d: str) -> DataFrame:
    """Each spelling with its entity."""
    return names.entities(*_t(spark, d, "author_names", "publisher_names", "doc_catalog"))


def p3_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return scans.paragraphs(table(spark, d, "doc_chunks"))


def p4_languages(spark: SparkSession, d: str) -> DataFrame:
    """Main language of each record and of each foreign passage, with confidence."""
    return langid.identify(*_t(spark, d, "doc_chunks", "doc_catalog")).drop("label_ok")


def _subjects(spark: SparkSession, d: str) -> list[DataFrame]:
    return _t(spark, d, "documents", "subject_labels", "doc_catalog", "subjects", "eval_items")


def p5_composition(spark: SparkSession, d: str) -> DataFrame:
    """The make-up of the corpus: documents of each subject, each counting by its share."""
    rows = written(subjects.assign(*_subjects(spark, d)), "subject-shares")
    return rows.groupBy("subject_code").agg(F.count("*").alias("n_documents"), F.round(F.sum("share"), 3).alias("document_shares"))


def p7_survivors(spark: SparkSession, d: str) -> DataFrame:
    return survivors.survivors(table(spark, d, "doc_catalog"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.containers(table(spark, d, "documents"))


def p10_masked(spark: SparkSession, d: str) -> DataFrame:
    return pii.masked(table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": lambda s, d: names.found(*_t(s, d, "author_names", "publisher_names", "doc_catalog")),
    "p2_entities": p2_entities,
    "p3_found": lambda s, d: scans.found(table(s, d, "doc_chunks")),
    "p3_paragraphs": p3_paragraphs,
    "p4_found": lambda s, d: langid.found(*_t(s, d, "doc_chunks", "doc_catalog")),
    "p4_languages": p4_languages,
    "p5_found": lambda s, d: subjects.found(*_subjects(s, d)),
    "p5_composition": p5_composition,
    "p7_found": lambda s, d: survivors.found(table(s, d, "doc_catalog")),
    "p7_survivors": p7_survivors,
    "p8_found": lambda s, d: packing.found(table(s, d, "documents")),
    "p8_containers": p8_containers,
    "p9_found": lambda s, d: leaks.found(*_t(s, d, "documents", "eval_items")),
    "p10_found": lambda s, d: pii.find(table(s, d, "documents")),
    "p10_masked": p10_masked,
}

_ISBN_SETS = r"""
WITH raw AS (
  SELECT md5, coalesce(is_full, false) AS f, coalesce(lower(trim(mime_type)) IN ('application/pdf', 'application/x-pdf'), false) AS p,
    coalesce(trim(content_url) <> '', false) AS c,
    list_transform(regexp_extract_all(regexp_replace(regexp_replace(isbn, '\([^)]*\)', ' ; ', 'g'), 'ISBN(-1[03])?:?', ' ; ', 'g'),
      '(?:97[89](?:[ -]?[0-9]){10}|[0-9](?:[ -]?[0-9]){8}[ -]?[0-9X])'), lambda x: regexp_replace(x, '[ -]', '', 'g')) AS items
  FROM doc_catalog WHERE isbn IS NOT NULL),
one AS (SELECT DISTINCT md5, f, p, c, unnest(items) AS item FROM raw),
full13 AS (
  SELECT md5, f, p, c, CASE WHEN length(item) = 13 THEN item ELSE concat('978', item[1:9], CAST((10 - (
    38 + CAST(item[1:1] AS INT) * 3 + CAST(item[2:2] AS INT) + CAST(item[3:3] AS INT) * 3 + CAST(item[4:4] AS INT) + CAST(item[5:5] AS INT) * 3
    + CAST(item[6:6] AS INT) + CAST(item[7:7] AS INT) * 3 + CAST(item[8:8] AS INT) + CAST(item[9:9] AS INT) * 3) % 10) % 10 AS VARCHAR)) END AS n
  FROM one),
sets AS (SELECT md5, f, p, c, string_agg(DISTINCT n, ', ' ORDER BY n) AS isbn_key FROM full13 GROUP BY md5, f, p, c)
"""

ORACLE: dict[str, str] = {
    "p7_found": _ISBN_SETS + """
SELECT a.isbn_key, a.md5 FROM sets a JOIN sets b ON a.isbn_key = b.isbn_key AND a.md5 <> b.md5
GROUP BY a.isbn_key, a.md5
HAVING bool_and(a.f >= b.f AND a.p >= b.p AND a.c >= b.c AND (a.f > b.f OR a.p > b.p OR a.c > b.c))""",
    "p8_found": "SELECT doc_id FROM documents WHERE octet_length(encode(text)) + 1 > 8192",
}
