from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, database

from varak.llm import packing


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 100), st.integers(0, 5) | st.none(), st.integers(0, 3) | st.none()), max_size=60))
def test_pack(items):
    sizes, clusters, sources = ([x[k] for x in items] for k in range(3))
    out = packing.pack(sizes, clusters, sources, 100)
    room, held = Counter(), defaultdict(Counter)
    for size, c, b in zip(sizes, clusters, out):
        room[b] += size
        held[b][c] += c is not None
    assert all(v <= 100 for v in room.values())
    least = max(1, -(-sum(sizes) // 100))
    counts = Counter(c for c in clusters if c is not None)
    assert all(n <= -(-counts[c] // least) for h in held.values() for c, n in h.items() if c is not None)


def test_hot_group_wastes_no_room():
    sizes = [10] * 3000
    assert max(packing.pack(sizes, [7] * 1500 + list(range(100, 1600)), [1] * 3000, 100)) + 1 <= 305


def test_table(spark):
    rows = [(1, "a" * 8191, "x"), (2, "b" * 8192, "x"), (3, None, "x"), (4, "", None), (5, "ә" * 9000, "y"), (6, "c" * 20, None), (6, "c" * 20, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, md5 string")
    got = packing.containers(df).toPandas()
    assert got.groupby("container_id").tokens.sum().max() <= packing.CAPACITY
    assert got.groupby("doc_id").tokens.sum().to_dict() == {1: 8192, 2: 8193, 4: 1, 5: 18001, 6: 42}
    assert sorted(r.doc_id for r in packing.found(df).collect()) == [2, 5]
    assert got[got.doc_id == 6].container_id.nunique() <= 2 and len(got[got.doc_id == 5]) == 3
    assert packing.containers(df.limit(0)).count() == 0


def test_fill(spark):
    got = packing.containers(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    n = got.container_id.nunique()
    assert n <= -(-got.tokens.sum() // packing.CAPACITY) + 2


def test_found_agrees_with_its_oracle(spark):
    sf = "/root/testdata/sf0.01"
    own, theirs, extra, missing = compare(spark, database(sf), "p8_found", sf)
    assert own == theirs > 0 and not extra and not missing


def test_found_reads_the_containers(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a" * 9000, None)], "doc_id bigint, text string, md5 string")
    real = packing.containers
    monkeypatch.setattr(packing, "containers", lambda d: real(d).withColumn("container_id", packing.F.lit("one")))
    assert packing.found(df).count() == 0
