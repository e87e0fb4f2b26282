import numpy as np
import pytest

from varak.llm import subjects

SF = "/root/testdata/sf0.01"


def tables(spark):
    return [spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "subject_labels", "doc_catalog", "subjects", "eval_items")]


@pytest.fixture(scope="module")
def placed(spark):
    documents, labels, catalog, codes, items = tables(spark)
    names = sorted(r.subject_code for r in codes.collect())
    kept = {}
    own = subjects.pooled
    subjects.pooled = lambda rows, share, group, c: kept.update(rows=rows, share=share, group=group, codes=c) or own(rows, share, group, c)
    try:
        kept["placed"], kept["model"] = subjects.fit(subjects.written(subjects.vectors(documents, items), "test"), labels, catalog, names)
    finally:
        subjects.pooled = own
    return kept


def met(spark, placed, model):
    rows = subjects.mixtures(placed["placed"], model).where(subjects.enough()).toPandas()
    pairs = set(map(tuple, rows[["doc_id", "subject_code"]].itertuples(index=False)))
    return np.mean([(r.doc_id, r.subject_code) in pairs for r in tables(spark)[1].toPandas().itertuples()]), rows


def test_hand_labels_are_met(spark, placed):
    share, rows = met(spark, placed, placed["model"])
    assert share > 0.8 and not rows.duplicated(["doc_id", "subject_code"]).any()


def test_subjects_come_from_the_leaves(spark, placed):
    order = np.random.default_rng(1).permutation(len(placed["share"]))
    shuffled = subjects.pooled(placed["placed"], placed["share"][order], placed["group"], placed["codes"])
    assert met(spark, placed, shuffled)[0] < 0.5


def test_copied_sentences():
    item = [[f"сүз{i}" for i in range(k, k + 10)] for k in (0, 10)]
    ids = subjects.leaks._Ids()
    known = np.unique(subjects.leaks._shingles(ids.of([w for s in item for w in s])))
    own = [[f"башка{i}" for i in range(10)]]
    assert subjects.copied(own + item + own, ids, known) == [False, True, True, False]


def test_items_beyond_a_block_are_copies_too(spark, monkeypatch):
    texts = [" ".join(f"{chr(1072 + k)}{chr(1072 + i)}төшенчә" for i in range(12)) + "." for k in range(6)]
    documents = spark.createDataFrame([(k, "m", f"Бу үз җөмләбез икән монда. {t}") for k, t in enumerate(texts)], "doc_id bigint, md5 string, text string")
    items = spark.createDataFrame([(t,) for t in texts], "item_text string")
    for size in (20_000, 2):
        monkeypatch.setattr(subjects.leaks, "BLOCK_ITEMS", size)
        assert [len(r.lengths) for r in subjects.vectors(documents, items).collect()] == [1] * 6


def test_edges(spark):
    documents, labels, catalog, codes, items = tables(spark)
    empty = documents.limit(0)
    assert subjects.found(empty, labels, catalog, codes, items).count() == 0
    odd = spark.createDataFrame([(1, None, None), (2, "", None), (3, "...", "x"), (3, "...", "x"), (None, "Бу бер җөмлә генә инде.", None)], "doc_id bigint, text string, md5 string")
    assert subjects.found(odd, labels.limit(0), catalog.limit(0), codes, items.limit(0)).count() == 0


def test_a_fifth_of_all_sentences_is_enough(spark):
    rows = [("fifth", 0.2, 1, 5), ("quarter", 0.25, 1, 4), ("passing", 0.2, 1, 6), ("many", 0.21, 3, 15), ("silent", 0.5, 1, 9)]
    df = spark.createDataFrame(rows, "subject_code string, share double, held int, sentences int")
    assert {r.subject_code for r in df.where(subjects.enough()).collect()} == {"fifth", "quarter", "many", "silent"}


def test_groups_outside_a_start_get_leaves(spark, monkeypatch):
    monkeypatch.setattr(subjects, "FANOUT", 4)
    rng = np.random.default_rng(3)
    kind = np.where(np.arange(9000) >= 8910, 2, np.arange(9000) % 2)  # one or none of these is in the first start
    units = np.sort(np.stack([1000 * k + rng.choice(30, 8, replace=False) for k in kind]), axis=1)
    x = subjects.dense(units.ravel(), np.full(9000, 8), np.ones(subjects.DIMS))
    points = spark.createDataFrame([(k, r) for k, r in enumerate(subjects._packed(x).to_pylist())], "doc_id bigint, point binary")
    leaf = subjects.grow(points, leaves=64).leaves(x)
    share = np.bincount(leaf[kind == 2], minlength=200) / np.maximum(np.bincount(leaf, minlength=200), 1)
    assert np.mean(share[leaf[kind == 2]] > 0.9) > 0.9


def test_bytes_hold_a_vector():
    x = subjects.dense(np.arange(40), np.array([25, 0, 15]), np.ones(subjects.DIMS))
    back = subjects._unpacked(subjects._packed(x).slice(1, 2))
    assert not back[0].any() and back[1] @ x[2] > 0.99
