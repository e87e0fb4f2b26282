"""Deeply nested records as related flat tables, by Merkle subtree identities.

Every object of a record is canonicalised and hashed bottom-up: keys are sorted and child objects are replaced by
their hashes, so equal subtrees have equal hashes wherever they occur. ``objects`` keeps each subtree once;
``bridge`` keeps every occurrence with its parent, its field and its ordinal.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import blake2b
from json.decoder import scanstring

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fields of a book, and of a work it is based on, whose elements are items even when they are bare strings.
BOOK_ITEMS = {"author": "author", "contributor": "contributor", "additionalProperty": "property", "isBasedOn": "work"}
WORK_ITEMS = {"author": "work_author", "isBasedOn": "work"}

_SCHEMA = "record string, root_hash string, parent_hash string, node_hash string, field string, child string, parent_pos int, pos int, ordinal int, path string, depth int, named boolean, body string"
_BLANK, _NUMBER = re.compile(r"[ \t\n\r]*"), re.compile(r"-?(?:0|[1-9]\d*)(\.\d+)?([eE][-+]?\d+)?")
_WORDS = {"true": True, "false": False, "null": None}
_FENCE = re.compile(r"^\s*```[a-zA-Z]*\s*|\s*```\s*$")


def read_deep(text: str) -> object:
    """JSON of any depth, read without recursion; ``ValueError`` where it is none."""
    stack: list[list] = []  # open containers, each with the key whose value is being read

    def blank(i: int) -> int:
        return _BLANK.match(text, i).end()

    def key_at(i: int) -> tuple[str, int]:
        if text[i : i + 1] != '"':
            raise ValueError(f"no key at {i}")
        key, i = scanstring(text, i + 1, True)
        i = blank(i)
        if text[i : i + 1] != ":":
            raise ValueError(f"no value at {i}")
        return key, blank(i + 1)

    i = blank(0)
    while True:
        c = text[i : i + 1]
        if c and c in "{[":
            value: object = {} if c == "{" else []
            i = blank(i + 1)
            if text[i : i + 1] != ("}" if c == "{" else "]"):
                key, i = key_at(i) if c == "{" else (None, i)
                stack.append([value, key])
                continue
            i += 1
        elif c == '"':
            value, i = scanstring(text, i + 1, True)
        elif m := _NUMBER.match(text, i):
            value, i = (float if m.group(1) or m.group(2) else int)(m.group()), m.end()
        elif word := next((w for w in _WORDS if text.startswith(w, i)), None):
            value, i = _WORDS[word], i + len(word)
        else:
            raise ValueError(f"no value at {i}")
        while True:
            i = blank(i)
            if not stack:
                if i < len(text):
                    raise ValueError(f"more at {i}")
                return value
            box, key = stack[-1]
            if isinstance(box, dict):
                box[key] = value
            else:
                box.append(value)
            c = text[i : i + 1]
            if c == ",":
                i = blank(i + 1)
                if isinstance(box, dict):
                    stack[-1][1], i = key_at(i)
                break
            if c != ("}" if isinstance(box, dict) else "]"):
                raise ValueError(f"not closed at {i}")
            value, i = stack.pop()[0], i + 1


def read_json(text: str) -> object:
    try:
        return json.loads(text)
    except RecursionError:
        return read_deep(text)


def read_record(text: str | None) -> dict | None:
    """The record held by ``text``: plain JSON, fenced JSON, JSON inside a JSON string, or the Book of an @graph.

    None for nulls, cut-off or otherwise unreadable text, and for anything that isn't an object.
    """
    value: object = text
    for _ in range(3):
        if not isinstance(value, str):
            break
        try:
            value = read_json(_FENCE.sub("", value.lstrip("\ufeff")))
        except ValueError:
            return None
    if isinstance(value, list):
        value = {"@graph": value}
    if isinstance(value, dict) and isinstance(value.get("@graph"), list) and "name" not in value:
        books = [x for x in value["@graph"] if isinstance(x, dict)]
        value = next((x for x in books if x.get("@type") == "Book"), books[0] if books else None)
    return value if isinstance(value, dict) else None


def _hash(body: str) -> str:
    return blake2b(body.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _children(value: object) -> Iterator[tuple[int, str, object]]:
    """Place, path and value of each element; lists inside lists are read through, each of their elements with a place.

    The path has the places on each level of lists, and an empty inner list keeps one place.
    """
    todo, place = [("", value)], 0
    while todo:
        path, x = todo.pop()
        if isinstance(x, list) and (x or not path):
            todo.extend((f"{path}/{k}" if path else str(k), y) for k, y in reversed([*enumerate(x, 1)]))
        else:
            place += 1
            yield place, path or "1", x


def _named(value: object) -> bool:
    if isinstance(value, str):
        return bool(value.strip())
    return isinstance(value, dict) and value.get("name") not in (None, "", [], {}) and str(value["name"]).strip() != ""


def merkle(value: object, memo: dict[int, tuple[str, str]]) -> tuple[str, str]:
    """Hash and canonical body of a subtree; child objects, and lists inside lists, stand in the body as their hashes.

    ``memo`` takes the hash and body of every object below; the walk is bottom-up without recursion.
    """
    todo = [(value, False)]
    while todo:
        x, ready = todo.pop()
        if not ready:
            todo.append((x, True))
            parts = [p for v in x.values() for p in (v if isinstance(v, list) else [v])] if isinstance(x, dict) else x if isinstance(x, list) else []
            todo.extend((p, False) for p in parts if isinstance(p, (dict, list)) and id(p) not in memo)
            continue
        short = {k: [_part(y, memo) for y in v] if isinstance(v, list) else _part(v, memo) for k, v in x.items()} if isinstance(x, dict) else [_part(y, memo) for y in x] if isinstance(x, list) else x
        body = json.dumps(short, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        memo[id(x)] = _hash(body), body
    return memo[id(value)]


def _part(value: object, memo: dict[int, tuple[str, str]]) -> object:
    return {"#": memo[id(value)][0]} if isinstance(value, (dict, list)) else value


def occurrences(record: dict) -> Iterator[tuple]:
    """Bridge rows of one record in reading order, the root first."""
    memo: dict[int, tuple[str, str]] = {}
    root, body = merkle(record, memo)
    yield root, None, root, None, None, 0, 1, 1, None, 0, _named(record), body
    works = 0
    stack = [(record, root, BOOK_ITEMS, 0, 1)]
    while stack:
        node, node_hash, items, number, depth = stack.pop()
        inner: list[tuple] = []
        for field in (f for f in node if f != "isBasedOn"):
            for k, path, x in _children(node[field]):
                child = items.get(field)
                if x is None or isinstance(x, list) or not (child or isinstance(x, dict)):
                    continue
                h, b = memo.get(id(x)) if isinstance(x, dict) else merkle(x, memo)
                yield root, node_hash, h, field, child, number, k, k, path, depth, _named(x), b
                if isinstance(x, dict):  # objects that are no items, and what items hold, are kept as plain links
                    inner.append((x, h, {}, number, depth + 1))
        stack.extend(reversed(inner))
        if "isBasedOn" in node and items.get("isBasedOn"):
            yield from _works(node, node_hash, root, number, depth, memo, works_from := [works], stack)
            works = works_from[0]


def _works(node: dict, node_hash: str, root: str, number: int, depth: int, memo: dict, count: list[int], stack: list) -> Iterator[tuple]:
    """Works in reading order: a work before those inside it, those before its next sibling."""
    todo = [(x, node_hash, number, k, path, depth) for k, path, x in reversed([*_children(node["isBasedOn"])])]
    while todo:
        x, parent, at, k, path, level = todo.pop()
        if not isinstance(x, (dict, str)) or x == "":
            continue
        count[0] += 1
        h, b = memo.get(id(x)) or merkle(x, memo)
        yield root, parent, h, "isBasedOn", "work", at, count[0], k, path, level, True, b
        if isinstance(x, dict):
            own = count[0]
            stack.append(({f: v for f, v in x.items() if f != "isBasedOn"}, h, WORK_ITEMS, own, level + 1))
            if "isBasedOn" in x:
                todo.extend((y, h, own, j, p, level + 1) for j, p, y in reversed([*_children(x["isBasedOn"])]))


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    for pdf in batches:
        out = []
        for key, text in zip(pdf["record"], pdf["meta"]):
            if (record := read_record(text)) is not None:
                out.extend((key, *x) for x in occurrences(record))
        yield pd.DataFrame(out, columns=names)


def bridge(df: DataFrame, key: str = "md5", column: str = "meta") -> DataFrame:
    """One row for each occurrence of an object, or of a bare string in an item field.

    ``record, root_hash, parent_hash, node_hash, field, child, parent_pos, pos, ordinal, path, depth, named, body``;
    ``ordinal`` is the place in the field, elements of inner lists counting one by one, and ``path`` their place on each
    level; ``child`` is null for objects that are no items (publisher, affiliation). Null, empty and unreadable texts give no
    rows, repeated input rows give repeated occurrences, other columns of ``df`` are not read. A narrow map: no shuffle.
    """
    return df.select(F.col(key).cast("string").alias("record"), F.col(column).alias("meta")).where("meta is not null").mapInPandas(_rows, _SCHEMA)


def objects(links: DataFrame) -> DataFrame:
    """Each distinct subtree once: ``node_hash, body, n_occurrences``. Partial aggregation runs before the shuffle."""
    return links.groupBy("node_hash").agg(F.first("body").alias("body"), F.count("*").alias("n_occurrences"))


def found(df: DataFrame) -> DataFrame:
    """The named items of each record with their place: ``md5, child, parent_pos, pos``."""
    return bridge(df).where("child is not null and (named or child = 'work')").select(F.col("record").alias("md5"), "child", "parent_pos", "pos")
