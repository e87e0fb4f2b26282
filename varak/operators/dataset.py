"""The structured dataset: rows, shards, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 20_000
SHARD_BYTES = 3 * 256 * 1024 * 1024


def rows(texts: DataFrame, catalog: DataFrame) -> DataFrame:
    """``id, publish_year, genre, text``; years outside 0..65535 are null, texts without record are left out."""
    year = F.col("publish_date").try_cast("int")
    meta = catalog.select("md5", F.when(year.between(0, 65535), year).alias("publish_year"), "genre")
    return texts.select("md5", "text").where("text is not null and text <> ''").join(meta, "md5").select(F.col("md5").alias("id"), "publish_year", "genre", "text")


def unmatched(texts: DataFrame, catalog: DataFrame) -> DataFrame:
    return texts.select("md5").join(catalog.select("md5"), "md5", "left_anti")


def shard_plan(df: DataFrame, key: str, size: str, max_rows: int = SHARD_ROWS, max_bytes: int = SHARD_BYTES) -> DataFrame:
    """``key, bucket, shard``: shard numbers by running rows and bytes inside buckets of a hash.

    There are as many buckets as the data fills shards, so no window spans more than about one shard whatever the size of
    the table. A shard is closed by the row that reaches ``max_rows`` or ``max_bytes``, rows counting in hash order.
    """
    totals = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))
    buckets = totals.select(F.greatest(F.lit(1), F.ceil(F.col("n") / max_rows), F.ceil(F.col("bytes") / max_bytes)).alias("buckets"))
    spread = df.join(F.broadcast(buckets)).withColumn("bucket", F.pmod(F.crc32(F.col(key).cast("string")), F.col("buckets")))  # one row
    w = Window.partitionBy("bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    rows, total = F.count("*").over(w), F.coalesce(F.sum(size).over(w), F.lit(0))
    return spread.select(key, "bucket", F.greatest(F.floor(rows / max_rows), F.floor(total / max_bytes)).cast("bigint").alias("shard"))


def counters(texts: DataFrame, catalog: DataFrame) -> DataFrame:
    """Run counters in one row: texts, empty texts, texts without record."""
    joined = texts.select("md5", "text").join(catalog.select("md5", F.lit(1).alias("known")), "md5", "left")
    return joined.agg(F.count("*").alias("n_texts"), F.count_if(F.coalesce("text", F.lit("")) == "").alias("n_empty"), F.count_if(F.col("known").isNull()).alias("n_unmatched"))
