"""What the extraction queries and their operators do beyond agreeing with SQL."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from varak.functions import text as T
from varak.operators import dataset, figures, reconcile, triage
from varak.plans import extraction
from varak.sources import files, sinks
from varak.sources.tables import discard, shared_dir, table, written

SF = "/root/testdata/sf0.001"
STEPS = ("strip_xml_declaration", "strip_word_export", "dehyphenate", "strip_images", "strip_img", "toc_marker", "cap_underscores", "unescape")


@pytest.mark.parametrize("step", STEPS)
def test_each_step_of_the_cleaning_is_met(spark, step):
    rows = table(spark, SF, "documents").where("text is not null").select(F.expr(extraction._MARKED.replace("''1.0''", "\\'1.0\\'").replace("''utf-8''", "\\'utf-8\\'")).alias("c"))
    assert rows.where(getattr(T, step)(F.col("c")) != F.col("c")).count() > 0


def test_views_hold_every_case(spark):
    q = entry.queries()
    rescued = q["types_rescued"](spark, SF)
    assert {r.mime_type for r in rescued.where("not skip").collect()} >= {"application/pdf", "text/plain"} and rescued.where("nontextual and not skip").count()
    assert "legal doc" in {r.reason for r in q["legal_documents"](spark, "/root/testdata/sf0.01").collect()}
    assert {r.status for r in q["extraction_triage"](spark, SF).collect()} == {"ok", "retry", "repairable", "unprocessable"}
    done = q["figures_replaced"](spark, SF)
    assert done.where("content like '%img alt%'").count() and done.where("content = 'before  after'").count()


def test_sizes_go_down():
    assert triage.rules.CHUNK_SIZES == (5, 3, 2, 1)


def test_size_after_failure(spark):
    rows = spark.createDataFrame([("client", 400, None, 5), ("validation", None, None, 2), ("client", 400, None, 1), ("client", 429, "PerDay", 3), (None, None, None, 4)], "error string, code int, message string, size int")
    assert [(r.status, r.size, r.key_expired) for r in triage.triaged(rows).collect()] == [("retry", 3, False), ("retry", 1, False), ("unprocessable", None, False), ("retry", 3, True), ("ok", 4, False)]


def test_shards_close_by_bytes(spark, tmp_path):
    rows = spark.range(400).select("id", F.repeat(F.lit("x"), 100).alias("text")).withColumn("bytes", F.lit(100))
    plan = dataset.shard_plan(rows, "id", "bytes", max_rows=1000, max_bytes=5000).groupBy("bucket", "shard").agg(F.sum(F.lit(100)).alias("b"))
    assert plan.agg(F.max("b")).first()[0] <= 5000 and plan.select("bucket").distinct().count() == 8
    sinks.write_shards(rows, f"{tmp_path}/out", key="id", size="bytes", max_bytes=5000)
    parts = [pq.read_metadata(p).num_rows for p in glob.glob(f"{tmp_path}/out/**/*.parquet", recursive=True)]
    assert sum(parts) == 400 and max(parts) <= 50


def test_matches_of_a_large_page(spark):
    pairs = spark.range(3000).select(F.lit(1).alias("page"), (F.col("id") % 60).alias("figure_id"), F.floor(F.col("id") / 60).alias("detected_id"), F.lit("iou").alias("method"), ((F.col("id") * 7919 % 1000) / 1000).alias("score"))
    got = figures.matches(pairs, ["page"]).collect()
    used: tuple[set, set] = set(), set()
    want = 0
    for r in sorted(pairs.collect(), key=lambda r: (-r.score, r.figure_id, r.detected_id)):
        if r.figure_id not in used[0] and r.detected_id not in used[1]:
            used[0].add(r.figure_id)
            used[1].add(r.detected_id)
            want += 1
    assert len(got) == want == 50


def test_batches_are_full(spark):
    keys = spark.range(250).select(F.concat(F.md5(F.col("id").cast("string")), F.lit(".zip")).alias("obj_key"))
    plan = keys.select(F.substring("obj_key", 1, 32).alias("md5"))
    sizes = sorted(r["count"] for r in reconcile.delete_batches(keys, plan, 100).groupBy("batch").count().collect())
    assert sizes == [50, 100, 100]


@pytest.mark.parametrize(("encoding", "text"), [("utf-8", "татарча әйбәт"), ("utf-8-sig", "татарча"), ("cp1251", "Это русский текст"), ("koi8-r", "Это русский текст"), ("koi8-r", "ТЕКСТ ЗАГЛАВНЫЙ"), ("latin-1", "café déjà vu")])
def test_encodings(encoding, text):
    assert files.decode(text.encode(encoding)) == text


def test_unknown_type_can_be_an_error(spark):
    rows = spark.createDataFrame([("a", "x/y")], "path string, mime string")
    assert rows.select(T.extension(F.col("path"), F.col("mime"))).first()[0] is None
    with pytest.raises(Exception, match="no extension"):
        rows.select(T.extension(F.col("path"), F.col("mime"), strict=True)).collect()


def test_written_tables_can_go(spark):
    df = written(spark.range(5), "gone")
    assert df.count() == 5 and df._written_to.startswith(shared_dir(spark))
    discard(df)
    assert not glob.glob(df._written_to.removeprefix("file:"))
