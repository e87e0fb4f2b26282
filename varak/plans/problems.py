"""Queries of the general data problems, with their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from varak.operators import nested, packed
from varak.sources.tables import table


def p1_objects(spark: SparkSession, d: str) -> DataFrame:
    """Each distinct object of all records once."""
    return nested.objects(nested.bridge(table(spark, d, "doc_catalog")))


def p1_bridge(spark: SparkSession, d: str) -> DataFrame:
    """Every occurrence with its record, parent and place."""
    return nested.bridge(table(spark, d, "doc_catalog")).drop("body")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": lambda s, d: nested.found(table(s, d, "doc_catalog")),
    "p1_objects": p1_objects,
    "p1_bridge": p1_bridge,
    "p6_found": lambda s, d: packed.split_rows(table(s, d, "doc_catalog")),
}

ORACLE: dict[str, str] = {}
