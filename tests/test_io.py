"""Readers, writers and incremental ingestion against real files."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from varak.sources import files, sinks
from varak.sources.tables import table
from varak.streaming.ingest import ingest

SF = "/root/testdata/sf0.001"


def test_walk_and_text_set(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "x.txt").write_text(" m1 \nm2\n\nm1\n")
    (tmp_path / "a" / "b" / "y.txt").write_text("m3\n")
    assert files.walk(spark, str(tmp_path)).count() == 2
    assert sorted(r.md5 for r in files.text_set(spark, f"{tmp_path}/a/x.txt").collect()) == ["m1", "m2"]
    assert files.contents(spark, str(tmp_path)).where("length(md5) = 32").count() == 2


def test_shards(spark, tmp_path):
    sinks.write_shards(table(spark, SF, "documents").select("doc_id").coalesce(1), f"{tmp_path}/out", max_rows=50)
    parts = glob.glob(f"{tmp_path}/out/*.parquet")
    assert sum(pq.read_metadata(p).num_rows for p in parts) == table(spark, SF, "documents").count()
    assert len(parts) > 1 and all(pq.read_metadata(p).num_rows <= 50 for p in parts)


def test_csv_and_backup(spark, tmp_path):
    rows = table(spark, SF, "doc_catalog").select("ya_path", "md5")
    sinks.write_csv(rows, f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == rows.count()
    sinks.backup({"main": rows, "second": rows.limit(3)}, f"{tmp_path}/backup")
    assert spark.read.option("header", True).csv(f"{tmp_path}/backup/second").count() == 3


def test_ingest_takes_each_file_once(spark, tmp_path):
    source = table(spark, SF, "listing")
    path, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    source.limit(40).write.parquet(path)
    ingest(spark, path, source.schema, out, state)
    first = spark.read.parquet(out).count()
    ingest(spark, path, source.schema, out, state)
    assert first and spark.read.parquet(out).count() == first
    assert spark.read.parquet(out).select("md5", "file_path", "resource_id").distinct().count() == first


def test_ingest_keeps_copies_at_other_paths(spark, tmp_path):
    source = table(spark, SF, "listing")
    path, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    one = source.where("entry_type = 'file' and md5 is not null").limit(1)
    one.unionByName(one).unionByName(one.withColumn("file_path", F.lit("/other"))).write.parquet(path)
    for _ in range(2):
        ingest(spark, path, source.schema, out, state)
    assert spark.read.parquet(out).count() == 2


def test_ingest_keeps_late_entries(spark, tmp_path):
    source = table(spark, SF, "listing")
    path, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"

    def add(days):  # one file each, so that there are several batches
        for md5, day in days:
            source.limit(1).selectExpr(*[{"entry_type": "'file' AS entry_type", "md5": f"'{md5}' AS md5", "listed_at": f"timestamp_ntz'{day}' AS listed_at"}.get(c, c) for c in source.columns]).coalesce(1).write.mode("append").parquet(path)

    add([(f"m{k}", f"20{23 - k // 6}-{12 - k % 6 * 2:02}-01 00:00:00") for k in range(10)])
    ingest(spark, path, source.schema, out, state)
    assert spark.read.parquet(out).count() == 10
    add([("m3", "2023-12-02 00:00:00"), ("late", "2019-01-01 00:00:00")])
    ingest(spark, path, source.schema, out, state)
    assert sorted(r.md5 for r in spark.read.parquet(out).collect()) == sorted([f"m{k}" for k in range(10)] + ["late"])
