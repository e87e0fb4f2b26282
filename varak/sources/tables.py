"""Readers of the parquet tables, and the places where jobs keep intermediate data."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table (a file or a folder of files) of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where it is unset, a session on one machine uses its warehouse folder; on a cluster there is no safe place.
    """
    if given := spark.conf.get("spark.checkpoint.dir", None):
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_varak_shared"


def written(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back; it stays columnar, and no task depends on lost executors.

    The files go when the driver ends, or before with ``discard``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where, fs = _file_system(spark, path)
    fs.deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes what ``written`` made, once nothing reads it any more."""
    where, fs = _file_system(df.sparkSession, df._written_to)
    fs.delete(where, True)


def _file_system(spark: SparkSession, path: str) -> tuple:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())
