"""Catalogue columns from records of every readable shape."""

import json

import __spark_entry__ as entry

BOOK = {"@context": "c", "@type": "Book", "name": "T", "author": {"name": "A"}, "publisher": "P", "genre": "Novel", "inLanguage": "tt", "numberOfPages": 98, "datePublished": "1990-01"}
LISTS = BOOK | {"author": ["A", None, {"name": "unknown"}, {"name": "B"}], "publisher": [{"name": "P"}], "genre": ["Novel", "Unknown"], "contributor": [None, {"name": "C", "role": "translator"}]}


def test_every_readable_shape(spark, tmp_path):
    graph = {"@graph": [{"@type": "Organization", "name": "x"}, BOOK]}
    metas = [json.dumps(BOOK), f"```json\n{json.dumps(BOOK)}\n```", json.dumps(json.dumps(BOOK)), json.dumps(graph), json.dumps(LISTS), '{"name": "T"}', json.dumps(BOOK)[:-9], "", None]
    rows = [(str(k), m, 100, "1985") for k, m in enumerate(metas)]
    spark.createDataFrame(rows, "md5 string, meta string, page_count int, publish_date string").write.parquet(f"{tmp_path}/doc_catalog.parquet")
    columns = ["publisher", "author", "title", "language", "publish_date", "page_count"]
    got = {r.md5: tuple(r[c] for c in columns) for r in entry.queries()["meta_flattened"](spark, str(tmp_path)).collect()}
    one = ("P", "A", "T", "tt", "1990", 98)
    assert got == {"0": one, "1": one, "2": one, "3": one, "4": ("P", "A, B", *one[2:]), "5": (None, None, "T", None, "1985", 100)}
    more = {r.md5: (r.genre, r.unreadable) for r in entry.queries()["meta_columns"](spark, str(tmp_path)).collect()}
    assert more == {str(k): ("novel", False) for k in range(5)} | {"5": (None, False), "6": (None, True), "7": (None, True)}
