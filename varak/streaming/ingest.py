"""Incremental ingestion of listings: bounded micro-batches over new files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def new_entries(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 8) -> DataFrame:
    """A stream of listing files: every entry of a file with a content hash, however late it was listed."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return stream.withColumn("seen_at", F.col("listed_at").cast("timestamp")).where("entry_type = 'file' and md5 is not null")


KEY = ("md5", "file_path", "resource_id")


def append_unknown(batch: DataFrame, out: str) -> None:
    """Appends the entries that the table at ``out`` lacks, each once; a repeated batch adds nothing.

    An entry is known by its hash, path and resource, so that the copies of one file all come in.
    """
    fresh = batch.dropDuplicates([*KEY]).alias("f")
    try:
        known = batch.sparkSession.read.schema(batch.schema).parquet(out).select(*KEY).alias("k")
    except AnalysisException as e:  # the first batch
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        fresh = fresh.join(known, [F.col(f"f.{c}").eqNullSafe(F.col(f"k.{c}")) for c in KEY], "left_anti").select(*batch.columns)
    fresh.write.mode("append").parquet(out)


def ingest(spark: SparkSession, path: str, schema: StructType, out: str, state: str) -> None:
    """Takes in all files there now and ends; run again, it takes in only what is new.

    ``out`` is a plain table. One that an earlier version wrote as a streaming sink must be started anew with ``state``.
    """
    query = new_entries(spark, path, schema).writeStream.foreachBatch(lambda batch, _: append_unknown(batch, out)).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
