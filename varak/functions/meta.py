"""Catalogue columns from a bibliographic JSON record."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from varak import rules
from varak.operators.nested import read_record
from varak.operators.packed import isbn_values

PERSON = "STRUCT<`@type`: STRING, name: STRING, role: STRING>"
BOOK = (
    f"STRUCT<name: STRING, author: ARRAY<{PERSON}>, contributor: ARRAY<{PERSON}>, publisher: {PERSON}, datePublished: STRING, isbn: ARRAY<STRING>, "
    "inLanguage: STRING, numberOfPages: STRING, additionalProperty: ARRAY<STRUCT<name: STRING, value: STRING>>, genre: ARRAY<STRING>>"
)


_PEOPLE, _LISTS, _TEXTS = ("author", "contributor"), ("isbn", "genre", "additionalProperty"), ("name", "datePublished", "inLanguage", "numberOfPages")


def _items(value: object) -> list | None:
    return value if value is None or isinstance(value, list) else [value]


def _person(value: object) -> object:
    return {"name": value} if isinstance(value, str) else value


def _text(value: object) -> str | None:
    flat, todo = [], [value]
    while todo:
        x = todo.pop()
        if isinstance(x, list):
            todo.extend(reversed(x))
        elif x is not None and not isinstance(x, dict):
            flat.append(x if isinstance(x, str) else json.dumps(x))
    return ", ".join(flat) if flat else None


def regular(text: str | None) -> str | None:
    """A readable record in the shape of ``BOOK``: lone items as lists, bare names as objects, one publisher."""
    if (record := read_record(text)) is None:
        return None
    out: dict[str, object] = {k: _text(record.get(k)) for k in _TEXTS}
    for k in _PEOPLE:
        people = _items(record.get(k))
        out[k] = people and [{f: _text(v) for f, v in p.items() if f in ("@type", "name", "role")} for x in people if isinstance(p := _person(x), dict)]
    for k in _LISTS:
        items = _items(record.get(k))
        out[k] = items and [{f: _text(x.get(f)) for f in ("name", "value")} if k == "additionalProperty" else _text(x) for x in items if x is not None and isinstance(x, dict) == (k == "additionalProperty")]
    publishers = [p for x in _items(record.get("publisher")) or [] if isinstance(p := _person(x), dict)]
    out["publisher"] = {"@type": _text(publishers[0].get("@type")), "name": _text([p.get("name") for p in publishers])} if publishers else None
    return json.dumps({k: v for k, v in out.items() if v is not None})


def book(c: Column) -> Column:
    """The record that a text holds in any readable form, else null."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(regular, na_action="ignore")

    return F.from_json(F.pandas_udf(run, "string")(c), BOOK)


def known(c: Column) -> Column:
    return F.when(F.lower(c) != "unknown", c)


def publisher(book: Column) -> Column:
    return known(book["publisher"]["name"])


def author(book: Column) -> Column:
    """Names joined by ", "; null where there is no list."""
    names = F.transform(book["author"], lambda a: a["name"])
    return F.array_join(F.filter(names, lambda n: n.isNotNull() & (F.lower(n) != "unknown")), ", ")


def title(book: Column) -> Column:
    return known(book["name"])


def language(book: Column) -> Column:
    parts = F.transform(F.split(book["inLanguage"], ","), lambda x: F.trim(x))
    return F.array_join(F.array_sort(F.filter(parts, lambda x: x != "")), ", ")


def genre(book: Column) -> Column:
    lower = F.transform(book["genre"], lambda g: F.lower(g))
    return F.array_join(F.filter(lower, lambda g: g.isNotNull() & (g != "unknown")), ", ")


def translated(book: Column) -> Column:
    return F.exists(book["contributor"], lambda c: F.coalesce(c["role"] == "translator", F.lit(False)))


def publish_date(book: Column, old: Column) -> Column:
    """The year of a date, else the value as it was."""
    date = F.trim(book["datePublished"])
    return F.when(date.rlike(r"^\d{4}[\d-]*$"), F.substring(date, 1, 4)).otherwise(old)


def isbn(book: Column) -> Column:
    """All ISBNs of ten or thirteen characters, distinct and sorted; empty when there is none."""
    found = F.flatten(F.transform(book["isbn"], isbn_values))
    return F.coalesce(F.array_join(F.array_sort(F.array_distinct(found)), ", "), F.lit(""))


def page_count(book: Column, old: Column) -> Column:
    """The record's number of pages where it is within five of the known one."""
    n = book["numberOfPages"].try_cast("int")
    return F.when(F.abs(n - old) < 5, n).otherwise(old)


def classification(book: Column, names: tuple[str, ...]) -> Column:
    """The value of the only property with one of these names, without blanks."""
    fits = F.filter(book["additionalProperty"], lambda p: F.upper(F.trim(p["name"])).isin(*names) & ~F.lower(p["value"]).isin("unknown", "неизвестно"))
    return F.when(F.size(fits) == 1, F.regexp_replace(F.trim(F.get(fits, F.lit(0))["value"]), r"[ \n]", ""))


def without_dropped_keys(c: Column) -> Column:
    """Supplied metadata, a flat JSON object, without the keys that are not kept; unreadable text gives null."""
    return F.to_json(F.map_filter(F.from_json(c, "map<string,string>"), lambda k, _: ~k.isin(*rules.DROPPED_KEYS)))
