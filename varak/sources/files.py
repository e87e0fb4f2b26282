"""Files as tables: folders, archives, text sets, encodings; and the services behind interfaces."""

from __future__ import annotations

import io
import zipfile
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Encodings tried in turn (fixed values).
ENCODINGS = ("utf-8", "cp1251", "koi8-r", "latin-1")


class Listing(Protocol):
    """A file store that lists its entries."""

    def entries(self, spark: SparkSession) -> DataFrame: ...


class Converter(Protocol):
    """Turns the bytes of an office document into Markdown."""

    def markdown(self, content: bytes, mime_type: str) -> str: ...


class Detector(Protocol):
    """Finds boxes on a page image."""

    def boxes(self, image: bytes) -> list[dict]: ...


def walk(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """All files below a folder: ``path, length, modified``. Nothing is deleted and no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def contents(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """As ``walk``, with ``content`` and its ``md5``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select("path", "content", F.md5("content").alias("md5"))


def to_fetch(keys: DataFrame, local: DataFrame) -> DataFrame:
    """Objects of a store that have no copy in a walked folder yet, by their last name: ``obj_key, name``."""
    name = lambda c: F.regexp_extract(c, r"([^/]+)$", 1).alias("name")
    return keys.select("obj_key", name("obj_key")).join(local.select(name("path")), "name", "left_anti").select("obj_key", "name")


def upstream_keys(keys: DataFrame) -> DataFrame:
    return keys.select(F.regexp_replace("obj_key", r"\.zip$", "").alias("md5"), F.col("url"))


def text_set(spark: SparkSession, path: str, name: str = "md5") -> DataFrame:
    """The distinct trimmed lines of text files."""
    return spark.read.text(path).select(F.trim("value").alias(name)).where(f"{name} <> ''").distinct()


def unzipped(c: Column) -> Column:
    """``text, error`` of an archive with exactly one member."""

    def one(data: bytes | None) -> dict:
        try:
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                members = z.namelist()
                if len(members) != 1:
                    return {"text": None, "error": f"{len(members)} members"}
                return {"text": z.read(members[0]).decode("utf-8"), "error": None}
        except (zipfile.BadZipFile, UnicodeDecodeError, TypeError) as e:
            return {"text": None, "error": type(e).__name__}

    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(x) for x in s], columns=["text", "error"])

    return F.pandas_udf(run, "text string, error string")(c)


def zipped(name: Column, text: Column) -> Column:
    """An archive with the member ``{name}.md``, packed as tightly as DEFLATE does."""

    def run(names: pd.Series, texts: pd.Series) -> pd.Series:
        out = []
        for n, t in zip(names, texts):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED, compresslevel=9) as z:
                z.writestr(zipfile.ZipInfo(f"{n}.md"), t or "", zipfile.ZIP_DEFLATED, 9)
            out.append(buffer.getvalue())
        return pd.Series(out)

    return F.pandas_udf(run, "binary")(name, text)


def decode(data: bytes | None) -> str | None:
    """Bytes as text: UTF-8 where it fits, else the encoding that makes the likeliest text.

    Letters and blanks speak for a reading, above all the common ones of Cyrillic and lower case after lower case; control
    characters, capitals inside words and two scripts in a word speak against it.
    """
    if data is None:
        return None
    best: tuple[float, str] | None = None
    for e in ENCODINGS:
        try:
            text = data.decode(e)
        except UnicodeDecodeError:
            continue
        if e == "utf-8":
            return text.removeprefix("\ufeff")
        score = _likely(text)
        if best is None or score > best[0]:
            best = score, text
    return best and best[1]


def _likely(text: str) -> float:
    score, before = 0.0, " "
    for c in text:
        low = c.lower()
        if c < " " and c not in "\t\n\r\f" or "\x7f" <= c < "\xa0":
            score -= 3
        elif c.isalpha():
            score += 1.5 if low in "оеаинтсрвл" else 1.0 if low in "кмдпуяыьгзбәөүҗңһ" else 0.2
            score -= 2.0 * (before.isalpha() and before.islower() and c.isupper())
            score -= 3.0 * (before.isalpha() and ("а" <= before.lower() <= "ӿ") != ("а" <= low <= "ӿ"))
        elif not c.isascii():
            score -= 0.5
        before = c
    return score


def decoded(c: Column) -> Column:
    def run(s: pd.Series) -> pd.Series:
        return s.map(decode)

    return F.pandas_udf(run, "string")(c)


def encrypt(url: Column, key: Column) -> Column:
    """A URL as ``enc:`` and URL-safe Base64 of nonce, ciphertext and tag. Each evaluation draws a new nonce: store it."""
    return F.when(url.isNotNull(), F.concat(F.lit("enc:"), F.translate(F.base64(F.aes_encrypt(url, key, F.lit("GCM"))), "+/", "-_")))


def decrypt(c: Column, key: Column) -> Column:
    raw = F.unbase64(F.translate(F.substring(c, F.lit(5), F.length(c)), "-_", "+/"))
    return F.when(c.startswith("enc:"), F.aes_decrypt(raw, key, F.lit("GCM")).cast("string")).otherwise(c)


def half_day(ts: Column) -> Column:
    """``yyyymmdd_n`` with the day changing at 09:00 UTC: 0 until midnight, 1 after it."""
    return F.concat(F.date_format(ts - F.expr("INTERVAL 9 HOURS"), "yyyyMMdd"), F.when(F.hour(ts) < 9, "_1").otherwise("_0"))
