"""Writers: dataset shards, CSV, backups, and what is missing in an object store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varak.operators.dataset import SHARD_BYTES, SHARD_ROWS, shard_plan


def write_shards(df: DataFrame, path: str, max_rows: int = SHARD_ROWS, key: str | None = None, size: str | None = None, max_bytes: int = SHARD_BYTES) -> None:
    """Snappy Parquet with at most ``max_rows`` rows in a file and 256 in a row group.

    With ``key`` and ``size``, the columns of a row's id and of its bytes, files are also closed at ``max_bytes``: each
    shard of the plan is a file of its own.
    """
    if key and size:
        plan = shard_plan(df.select(key, size), key, size, max_rows, max_bytes).distinct()
        df = df.join(plan, key).repartition("bucket", "shard").sortWithinPartitions("bucket", "shard", key)
    writer = df.drop("bucket", "shard").write if not key else df.write.partitionBy("bucket", "shard")
    writer = writer.mode("overwrite").option("maxRecordsPerFile", max_rows).option("parquet.block.row.count.limit", "256")
    writer.option("compression", "snappy").parquet(path)


def write_csv(df: DataFrame, path: str, order: str = "ya_path", compression: str = "none") -> None:
    """CSV with a header, in order over its part files; nulls in the order come last."""
    df.orderBy(F.col(order).asc_nulls_last()).write.mode("overwrite").option("header", "true").option("compression", compression).csv(path)


def backup(tables: dict[str, DataFrame], path: str) -> None:
    """Every table as gzipped CSV in a folder of its name."""
    for name, df in tables.items():
        write_csv(df, f"{path}/{name}", df.columns[0], "gzip")


def missing(artifacts: DataFrame, keys: DataFrame) -> DataFrame:
    """Artifacts whose key is not in the store yet, by equality of the whole key."""
    return artifacts.join(keys.select("obj_key"), "obj_key", "left_anti")
