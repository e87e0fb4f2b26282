import pytest
from oracle import compare, database

from varak.llm import survivors


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    own, theirs, extra, missing = compare(spark, database(sf), "p7_found", sf)
    assert own == theirs and not extra and not missing


def test_consensus():
    whole = []
    for v, w in (("Тукай Габдулла шигырьләр", 3.0), ("Тукай Габдулла", 1.0), ("Габдулла Тукай шигырьләр", 1.0)):
        p = survivors.profile_of(v, w)
        whole = survivors.align(whole, p) if whole else p
    assert survivors.consensus(whole) == ["Тукай", "Габдулла", "шигырьләр"]
    assert survivors.distance("а б в".split(), "а в".split()) == 1 and survivors.distance([], ["а"]) == 1


FIELDS = "md5 string, isbn string, is_full boolean, mime_type string, content_url string, title string, author string, publisher string, publish_date string, language string, genre string, updated_at timestamp_ntz, beats_all int"


def record(md5, isbn="9785918860012", full=None, mime=None, url=None, title=None):
    return (md5, isbn, full, mime, url, title, None, None, None, None, None, None, 0)


def test_cases(spark):
    rows = [
        record("a", full=True, mime="Application/PDF", title="Китап бер"), record("b", isbn="591886001X; 9785918860012", title="x"), record("c", full=True, mime="text/plain", title="Китап бер"),
        record("d", isbn="9785000000016"), record("d", isbn="9785000000016"), record("e", isbn="9785000000023", url="u"), record("f", isbn="ISBN 978-5-00000-002-3", url=" "), record("g", isbn=None), record("h", isbn="unknown"),
    ]
    df = spark.createDataFrame(rows, FIELDS)
    got = {r.isbn_key: r for r in survivors.survivors(df).collect()}
    one = got["9785918860012"]
    assert one.md5 == "a" and one.beats_all and one.title == "Китап бер"
    assert got["9785000000023"].md5 == "e" and "9785000000016" not in got
    assert survivors.survivors(df.limit(0)).count() == 0


def test_large_group_is_reduced_in_blocks(spark):
    rows = [record(f"{k:04}", full=k == 77, mime="application/pdf" if k in (77, 78) else None, url=f"u{k}" if k % 2 else None, title=f"Уртак исем {k}" if k % 7 else "Уртак исем") for k in range(2100)]
    got = survivors.survivors(spark.createDataFrame(rows + rows[:9], FIELDS)).collect()
    assert [(r.n_records, r.title, r.md5, r.beats_all, r.is_full, r.mime_type) for r in got] == [(2100, "Уртак исем", "0077", True, True, "application/pdf")]
    assert got[0].content_url == "u77"


def test_blocks_agree_with_whole_groups(spark, monkeypatch):
    rows = [record(f"{k:02}", isbn=f"978591886{g:03}{k % 2}", full=(k * g) % 5 == 1, mime="application/pdf" if (k + g) % 3 else "text/plain", url="u" if k % 4 < g else None, title=f"Исем {k % 3}") for g in range(5) for k in range(12)]
    df = spark.createDataFrame(rows, FIELDS)
    want = sorted(tuple(r) for r in survivors.found(df).collect())
    monkeypatch.setattr(survivors, "BLOCK", 2)
    assert sorted(tuple(r) for r in survivors.found(df).collect()) == want and want


def test_the_case_comes_from_the_consensus(spark, monkeypatch):
    df = spark.createDataFrame([record("a", full=True, title="x"), record("b", title="x")], FIELDS)
    assert [tuple(r) for r in survivors.found(df).collect()] == [("9785918860012", "a")]
    records = [{"md5": m, "f": f, "p": 0, "c": 0, "at": 0, **dict.fromkeys(survivors.FIELDS), "is_full": str(bool(f)).lower()} for m, f in (("a", 1), ("b", 0))]
    assert survivors.settled(records)["md5"] == "a"
    monkeypatch.setattr(survivors, "consensus", lambda profile: [])
    assert not survivors.settled(records)["beats_all"]


@pytest.mark.parametrize("title", ["x " * 60_000, "сүз"])
def test_long_values(spark, title):
    df = spark.createDataFrame([record("a", title=title), record("b", title=title + "y"), record("c", title=title)], FIELDS)
    assert survivors.survivors(df).first().title == title.strip()


def test_long_values_are_voted_on_by_tokens(spark):
    words = [f"сүз{k}" for k in range(1500)]
    wrong = lambda *at: " ".join("0" if k in at else w for k, w in enumerate(words))
    df = spark.createDataFrame([record("a", title=wrong(0, 7, 900)), record("b", title=wrong(1400)), record("c", title=wrong(3, 800))], FIELDS)
    got = survivors.survivors(df).first()
    assert (got.md5, got.title) == ("b", wrong(1400))


def test_alignment_is_the_same_in_parts(monkeypatch):
    values = [" ".join("абвг"[(k * k * s + k) % 4] for k in range(40 + s)) for s in (1, 3, 5)]
    parts = [survivors.profile_of(v, 1.0 + i) for i, v in enumerate(values)]
    want = survivors.merged(parts)
    monkeypatch.setattr(survivors, "CELLS", 1)
    monkeypatch.setattr(survivors, "MANY", 0)
    assert survivors.merged(parts) == want and len(want) < sum(len(p) for p in parts)
