import json

import pytest

from varak.operators import nested


def rows(spark, *metas):
    return spark.createDataFrame([(f"r{i}", m, "clash", "clash") for i, m in enumerate(metas)], "md5 string, meta string, pos string, child string")


def cases(spark, *metas):
    return sorted(tuple(r) for r in nested.found(rows(spark, *metas)).collect())


def test_places(spark):
    book = {"author": [None, {"name": "A"}, "B", {"x": 1}], "contributor": {"name": "C"}, "additionalProperty": {"name": "P", "value": 1}, "isBasedOn": [{"author": "W", "isBasedOn": {"name": "in"}}, {"name": "second", "author": [{"name": "V"}]}]}
    assert cases(spark, json.dumps(book)) == [
        ("r0", "author", 0, 2), ("r0", "author", 0, 3), ("r0", "contributor", 0, 1), ("r0", "property", 0, 1),
        ("r0", "work", 0, 1), ("r0", "work", 0, 3), ("r0", "work", 1, 2), ("r0", "work_author", 1, 1), ("r0", "work_author", 3, 1),
    ]


def test_shapes(spark):
    plain = {"@type": "Book", "author": "A"}
    forms = [json.dumps(plain), "```json\n" + json.dumps(plain) + "\n```", json.dumps(json.dumps(plain)), json.dumps({"@graph": [{"@type": "Organization", "name": "x"}, plain]})]
    assert cases(spark, *forms) == [(f"r{i}", "author", 0, 1) for i in range(4)]


def test_unreadable(spark):
    assert cases(spark, None, "", "{", '{"author": [{"name": "A"}', "[]", "3", "null", "[" * 100000) == []
    assert nested.found(rows(spark).limit(0)).count() == 0


def test_shared_subtrees(spark):
    meta = json.dumps({"author": [{"name": "A", "@type": "P"}, {"@type": "P", "name": "A"}]})
    links = nested.bridge(rows(spark, meta, meta))
    assert links.count() == 6 and links.where("child = 'author'").select("node_hash").distinct().count() == 1
    assert {r.n_occurrences for r in nested.objects(links).collect()} == {2, 4}


def test_long_list(spark):
    assert len(cases(spark, json.dumps({"author": [f"n{i}" for i in range(5000)]}))) == 5000


def test_lists_inside_lists(spark):
    meta = json.dumps({"author": [[{"name": "a"}, {"name": "b"}], [], "c"], "isBasedOn": [[{"name": "w", "author": [["v"]]}]]})
    assert cases(spark, meta) == [("r0", "author", 0, 1), ("r0", "author", 0, 2), ("r0", "author", 0, 4), ("r0", "work", 0, 1), ("r0", "work_author", 1, 1)]
    links = {(r.child, r.path) for r in nested.bridge(rows(spark, meta)).where("child is not null").collect()}
    assert links == {("author", "1/1"), ("author", "1/2"), ("author", "3"), ("work", "1/1"), ("work_author", "1/1")}


def test_any_depth(spark):
    work = '{"name":"w","isBasedOn":' * 60_000 + "{}" + "}" * 60_000
    got = cases(spark, '{"author":"A","isBasedOn":' + work + "}")
    assert len(got) == 60_002 and got[0] == ("r0", "author", 0, 1)
    assert ("r0", "work", 60_000, 60_001) in got
    assert cases(spark, '{"author":"A","x":' + "[" * 60_000 + "]" * 60_000 + "}") == [("r0", "author", 0, 1)]


def test_deep_reader_reads_what_json_reads():
    for text in ('{"a": [1, -2.5e3, true, null, "\\u0442\\n"], "b": {}, "c": [[], {"d": false}]}', " 3 ", '"x"', "[]"):
        assert nested.read_deep(text) == json.loads(text)
    for text in ("", "{", "[1,]", '{"a" 1}', "[1] 2", '{"a":1,}', "tru"):
        with pytest.raises(ValueError):
            nested.read_deep(text)
