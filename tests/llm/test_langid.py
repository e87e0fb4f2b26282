from pyspark.sql import functions as F

from varak.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    """Blocks with letters of one language only are recognised as that language."""
    chunks, catalog = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("doc_chunks", "doc_catalog"))
    profiles = langid.Profiles(langid.fit(chunks, catalog))
    tests = {"ba-Cyrl": "Беҙҙең ауыл эргәһендә ҙур йылға аға, балалар һыу инә.", "tt-Cyrl": "Безнең авыл янында зур елга ага, балалар су керә җәй көне.", "ru-Cyrl": "Около нашей деревни течёт большая река, дети часто купаются.", "en-Latn": "Near our village there is a large river where children swim.", "tt-Latn": "Bezneñ awıl yanında zur yılga aga, balalar su kerä cäy köne."}
    d, _ = profiles.distances(list(tests.values()))
    assert [profiles.tags[k] for k in d.argmin(axis=1)] == list(tests)


def test_found_shapes(spark):
    chunks, catalog = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("doc_chunks", "doc_catalog"))
    rows = langid.found(chunks, catalog).toPandas()
    assert (rows[rows.chunk_id == -1].block_no == -1).all() and (rows[rows.chunk_id > 0].block_no >= 0).all()
    assert not rows.duplicated(["md5", "chunk_id", "block_no"]).any()


def test_labels(spark):
    labels = ["tt", "TT-cyrl", "татар", "ru-Cyrl, tt-Cyrl", "tt-Latn", "", None, "ru"]
    df = spark.createDataFrame([(x,) for x in labels], "l string").select(langid.names_language(F.col("l"), F.lit("tt-Cyrl")))
    assert [r[0] for r in df.collect()] == [True, True, True, True, False, False, False, False]


def test_edges(spark):
    chunks = spark.createDataFrame([(1, "a", None), (2, "a", ""), (3, None, "текст"), (4, "b", "12 34")], "chunk_id bigint, md5 string, content string")
    catalog = spark.createDataFrame([("a", "ru", "x"), ("b", None, "y")], "md5 string, language string, lang_tag string")
    assert langid.found(chunks, catalog).count() == 0 and langid.found(chunks.limit(0), catalog.limit(0)).count() == 0
    assert langid.blocks_of("a\n\nb\n \nc\n\n\nd") == ["a", "b", "c", "", "d"] or len(langid.blocks_of("a\n\nb\n \nc")) == 3
