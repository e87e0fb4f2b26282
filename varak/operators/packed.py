"""Several values packed in one field, as one row per value with its position.

A string is split on quote characters: pieces at odd places are literals, pieces at even places are split on
delimiters, and an array fold puts the values together again in order. All of it is built-in SQL, so it stays inside
the JVM and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUOTES = '["«»“”„]'
#: Delimiters beside the comma, which also stands inside "Surname, Given".
HARD = r"(?U)\s*(?:;+|\|+|/+|[\r\n]+|,(?:\s*,)+|\s&\s|\s(?:и|һәм|and|менән бергә)\s)\s*"
OTHERS = r"(?iU)[\s,;]*(?<![\p{L}])(?:и др\b\.?|и другие|һ\.\s?б\.?|һәм башкалар|et al\b\.?|and others)\s*$"
TITLES = r"(?iU)^(?:(?:акад|проф|док|доц|prof|dr)\.\s*)+"
#: Fields that only say that nothing is known.
UNKNOWN = r"(?iU)^[\s\[(]*(?:unknown|anonymous|n/?a|none|null|нет|неизвестно|неизвестен|неизв\.?|билгесез|без автора|аноним|[-–—?.]*)[\s\])]*$"
ISBN = r"(?<![0-9A-Za-z])(?:97[89](?:[ \-–]?[0-9]){10}|[0-9](?:[ \-–]?[0-9]){8}[ \-–]?[0-9XxХх])(?![0-9A-Za-z])"
ISBN_MARK = r"(?i)ISBN(?:[ -]?1[03](?=\s*:))?\s*:?"

_SEP = "\u0001"


def _pieces(c: Column) -> Column:
    """Pieces between quotes; with an odd number of quotes the marks are only removed, as nothing is enclosed."""
    bare = F.when(c.rlike(r"(?s)^\s*\[.*\]\s*$"), F.regexp_replace(c, r"(?s)^\s*\[|\]\s*$", "")).otherwise(c)
    parts = F.split(bare, QUOTES, -1)
    return F.when(F.size(parts) % 2 == 1, parts).otherwise(F.array(F.regexp_replace(bare, QUOTES, "")))


def _commas(c: Column) -> Column:
    """Splits at commas, but keeps "Surname, Given" and "Surname, I. O." together."""
    last = lambda acc: F.element_at(acc, -1)

    def step(acc: Column, x: Column) -> Column:
        surname = F.regexp_replace(F.trim(last(acc)), TITLES, "").rlike(r"^[^\s.]+$")
        given = F.trim(x).rlike(r"^\S+(?:\s+\S+)?$")
        joined = F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.concat(last(acc), F.lit(","), x)))
        return F.when((F.size(acc) > 0) & surname & given, joined).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.split(c, ",", -1), F.array().cast("array<string>"), step)


def _even(c: Column, names: bool) -> Column:
    """Fragments of an unquoted piece."""
    hard = F.split(F.regexp_replace(F.regexp_replace(c, OTHERS, ""), HARD, _SEP), _SEP, -1)
    return F.flatten(F.transform(hard, _commas if names else lambda x: F.split(x, ",", -1)))


def values(c: Column, names: bool = True) -> Column:
    """The values packed in ``c`` in order, trimmed, without empty ones; ``names`` guards commas inside a name."""
    zero = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("cur"), F.lit(0).alias("i"))

    def step(acc: Column, piece: Column) -> Column:
        frags = _even(piece, names)
        literal = F.struct(acc["out"].alias("out"), F.concat(acc["cur"], piece).alias("cur"), (acc["i"] + 1).alias("i"))
        one = F.struct(acc["out"].alias("out"), F.concat(acc["cur"], frags[0]).alias("cur"), (acc["i"] + 1).alias("i"))
        many = F.struct(
            F.concat(acc["out"], F.array(F.concat(acc["cur"], frags[0])), F.slice(frags, F.lit(2), F.greatest(F.size(frags) - 2, F.lit(0)))).alias("out"),
            F.element_at(frags, -1).alias("cur"),
            (acc["i"] + 1).alias("i"),
        )
        return F.when(acc["i"] % 2 == 1, literal).when(F.size(frags) == 1, one).otherwise(many)

    folded = F.aggregate(_pieces(c), zero, step, lambda acc: F.concat(acc["out"], F.array(acc["cur"])))
    trimmed = F.transform(folded, lambda x: F.regexp_replace(x, r"(?U)^[\s,;]+|[\s,;]+$", ""))
    return F.filter(trimmed, lambda x: x != "")


def author_values(c: Column) -> Column:
    """Names in order. Null, empty and unknown fields give an empty array."""
    kept = F.filter(values(c), lambda x: ~x.rlike(UNKNOWN) & ~x.rlike(r"^[(\[][^)\]]*[)\]]$"))
    return F.coalesce(kept, F.array().cast("array<string>"))


def isbn_values(c: Column) -> Column:
    """ISBNs in order as their ten or thirteen characters. Remarks, marks and other numbers are left out."""
    clean = F.regexp_replace(F.regexp_replace(c, r"\([^)]*\)", " ; "), ISBN_MARK, " ; ")
    found = F.flatten(F.transform(values(clean, names=False), lambda x: F.regexp_extract_all(x, F.lit(ISBN), F.lit(0))))
    return F.coalesce(F.transform(found, lambda x: F.translate(F.regexp_replace(x, r"[ \-–]", ""), "xхХ", "XXX")), F.array().cast("array<string>"))


def isbn13(c: Column) -> Column:
    """A ten- or thirteen-character ISBN as thirteen digits."""
    stem = F.concat(F.lit("978"), F.substring(c, 1, 9))
    total = sum((F.substring(stem, k, 1).cast("int") * (1 if k % 2 else 3) for k in range(1, 13)), F.lit(0))
    return F.when(F.length(c) == 13, c).otherwise(F.concat(stem, ((10 - total % 10) % 10).cast("string")))


def isbn_key(c: Column) -> Column:
    """The set of ISBNs of a field as sorted thirteen-digit numbers joined with ", "; empty when there is none."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(isbn_values(c), isbn13))), ", ")


def split_rows(df: DataFrame, key: str = "md5") -> DataFrame:
    """``md5, field_name, pos, item``: one row for each value in ``isbn`` and ``author``.

    Fields that are null, empty or say only "unknown" give no row; repeated rows give repeated values; columns other
    than the key and the two fields are not read.
    """
    fields = df.select(F.col(key).alias("md5"), F.explode(F.array(
        F.struct(F.lit("isbn").alias("field_name"), isbn_values(F.col("isbn")).alias("items")),
        F.struct(F.lit("author").alias("field_name"), author_values(F.col("author")).alias("items")),
    )).alias("f"))
    rows = fields.select("md5", "f.field_name", F.posexplode("f.items").alias("p", "item"))
    return rows.select("md5", "field_name", (F.col("p") + 1).alias("pos"), "item")
