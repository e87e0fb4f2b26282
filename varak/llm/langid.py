"""Language of records and of foreign passages, by rank-order n-gram profiles.

A profile is the list of a language's most frequent character trigrams by rank. A text is compared with each profile
by out-of-place distance: the sum, over its own trigrams, of how far their rank is from the rank in the profile, with
a fixed distance for trigrams the profile lacks. Everything runs on NumPy arrays over whole Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varak.sources.tables import written

TAGS = ("tt-Cyrl", "tt-Latn", "ru-Cyrl", "ba-Cyrl", "en-Latn")
#: What a label calls each language, folded to lower case (fixed values). A bare language name leaves the script open.
NOTATIONS = {
    "tt-Cyrl": ("tt-cyrl", "tt_cyrl", "tatar-cyrl", "tat-cyrl"), "tt-Latn": ("tt-latn", "tt_latn", "tat-latn"),
    "ru-Cyrl": ("ru-cyrl", "ru_cyrl", "ru", "rus", "russian", "русский", "рус", "урыс", "русча"),
    "ba-Cyrl": ("ba-cyrl", "ba_cyrl", "ba", "bak", "bashkir", "башҡорт", "башкирский", "башкорт"),
    "en-Latn": ("en-latn", "en_latn", "en", "eng", "english", "английский", "инглиз"),
}
TATAR = ("tt", "tat", "tatar", "татар", "татарский", "татарча", "татар теле")
PROFILE = 1500
#: Bound of the labelled sample from which the profiles are fitted: chunk rows per language.
SAMPLE_ROWS = 600
SAMPLE_RECORDS = 200
MIN_LETTERS = 24
MARGIN = 0.04

_LETTERS = "abcdefghijklmnopqrstuvwxyzäöüñçşığéабвгдежзийклмнопрстуфхцчшщъыьэюяёәөүҗңһғҡҙҫ"
_BASE = 128
_LUT = np.zeros(0x10000, dtype=np.int64)
for _i, _c in enumerate(_LETTERS, 1):
    _LUT[ord(_c)] = _i
_QUOTED = re.compile(r"«[^»\n]{0,200}»|“[^”\n]{0,200}”|\"[^\"\n]{0,200}\"")
_BLANK = re.compile(r"\n[^\S\n]*\n")
_END = re.compile(r"[.!?…][\"»”)]*[^\S\n]*$", re.M)  # a sentence that ends a line


def blocks_of(content: str) -> list[str]:
    """Content split at empty lines; each empty line ends a block, so runs of them leave empty blocks."""
    return _BLANK.split(content)


def _counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigram counts of each text: text index, trigram, count, and the letters of each text."""
    joined = "\x00".join(texts).lower()
    code = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)
    at = np.cumsum(code == 0)
    ids = _LUT[np.minimum(code, 0xFFFF)]
    letters = np.bincount(at[ids > 0], minlength=len(texts))
    if len(ids) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), letters
    a, b, c = ids[:-2], ids[1:-1], ids[2:]
    ok = (b > 0) & ((a > 0) | (c > 0))
    key = at[1:-1][ok] * _BASE**3 + a[ok] * _BASE**2 + b[ok] * _BASE + c[ok]
    key.sort()
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    n = np.diff(np.r_[first, len(key)])
    key = key[first]
    return key // _BASE**3, key % _BASE**3, n, letters


def _ranks(text: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rank of each trigram inside its text; equally frequent trigrams share the middle of their ranks."""
    if not len(n):
        return np.empty(0)
    order = np.lexsort((-n, text))
    t, m = text[order], n[order]
    start = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
    place = np.arange(len(t)) - np.repeat(start, np.diff(np.r_[start, len(t)]))
    tie = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (m[1:] != m[:-1])])
    size = np.diff(np.r_[tie, len(t)])
    shared = np.repeat(place[tie] + (size - 1) / 2, size)
    out = np.empty(len(t))
    out[order] = shared
    return out


class Profiles:
    """Trigram ranks of each language in one dense table."""

    def __init__(self, ranked: dict[str, list[int]]) -> None:
        self.tags = [t for t in TAGS if ranked.get(t)]
        self.table = np.full((max(1, len(self.tags)), _BASE**3), PROFILE, dtype=np.int16)
        for k, t in enumerate(self.tags):
            self.table[k, np.asarray(ranked[t][:PROFILE])] = np.arange(len(ranked[t][:PROFILE]), dtype=np.int16)

    def distances(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean out-of-place distance of each text to each profile, between 0 and 1, and the letters of each text."""
        text, gram, n, letters = _counts(texts)
        rank = _ranks(text, n)
        total = np.bincount(text, weights=n, minlength=len(texts)) if len(text) else np.zeros(len(texts))
        out = np.ones((len(texts), max(1, len(self.tags))))
        for k in range(len(self.tags)):
            place = self.table[k, gram]
            far = np.where(place >= PROFILE, PROFILE, np.minimum(np.abs(place - rank), PROFILE))
            out[:, k] = np.bincount(text, weights=far * n, minlength=len(texts)) / np.maximum(total, 1) / PROFILE if len(text) else 1.0
        return out, letters


def fit(chunks: DataFrame, catalog: DataFrame) -> dict[str, list[int]]:
    """Profiles from a bounded sample of labelled rows.

    Of each language, ``SAMPLE_RECORDS`` records labelled with it alone and ``SAMPLE_ROWS`` of their chunks are taken
    in the order of a hash (the window keeps a group limit before its shuffle), so that the same rows are taken in any partitioning. Wrong labels are a minority: the
    blocks that a first profile gives to another language are left out of the final one.
    """
    folded = F.lower(F.trim(F.col("language")))
    tag = F.coalesce(*[F.when(folded.isin([*NOTATIONS[t], *(TATAR if t == "tt-Cyrl" else ())]), F.lit(t)) for t in TAGS])
    first = lambda df, key, n: df.withColumn("k", F.row_number().over(Window.partitionBy("tag").orderBy(F.xxhash64(key), key))).where(F.col("k") <= n).drop("k")
    records = first(catalog.select("md5", tag.alias("tag")).where("tag is not null and md5 is not null"), "md5", SAMPLE_RECORDS)
    own = chunks.select("md5", "chunk_id", "content").where("content is not null").join(F.broadcast(records), "md5")
    texts: dict[str, list[str]] = {t: [] for t in TAGS}
    for r in first(own, "chunk_id", SAMPLE_ROWS).select("tag", "content").collect():
        texts[r.tag] += blocks_of(r.content)
    ranked = {t: _top(v) for t, v in texts.items()}
    for _ in range(2):
        first = Profiles(ranked)
        for t, v in texts.items():
            if v and t in first.tags:
                d, letters = first.distances(v)
                kept = [x for x, i, n in zip(v, d.argmin(axis=1), letters) if first.tags[i] == t and n >= MIN_LETTERS]
                ranked[t] = _top(kept) or ranked[t]
    return ranked


def _top(texts: list[str]) -> list[int]:
    _, gram, n, _ = _counts(["\n".join(texts)])
    return [int(g) for g in gram[np.lexsort((gram, -n))][:PROFILE]]


def votes(chunks: DataFrame, ranked: dict[str, list[int]]) -> DataFrame:
    """Per chunk: the letters of each language's blocks, and its sentence blocks with language and confidence."""
    schema = "md5 string, chunk_id bigint, letters array<bigint>, block_no array<int>, tag array<int>, confidence array<double>"
    shared = chunks.sparkSession.sparkContext.broadcast(ranked)  # at most len(TAGS) * PROFILE integers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        profiles = Profiles(shared.value)
        index = {k: TAGS.index(t) for k, t in enumerate(profiles.tags)}
        for whole in batches:
            for lo in range(0, len(whole), 500):
                pdf = whole.iloc[lo : lo + 500]
                where, no, texts, sentence = [], [], [], []
                for i, content in enumerate(pdf["content"]):
                    for k, b in enumerate(blocks_of(content)):
                        body = _QUOTED.sub(" ", b)
                        where.append(i)
                        no.append(k)
                        texts.append(body.replace("\x00", " "))
                        sentence.append(not b.lstrip().startswith("#") and _END.search(body) is not None)
                out = [[], [], [], []]
                for _ in range(len(pdf)):
                    for x, v in zip(out, ([0] * len(TAGS), [], [], [])):
                        x.append(v)
                if profiles.tags and texts:
                    d, letters = profiles.distances(texts)
                    order = np.sort(d, axis=1)
                    second = order[:, 1] if d.shape[1] > 1 else np.ones(len(d))
                    sure = (second - order[:, 0]) / np.maximum(second, 1e-9)
                    for i, k, best, n, c, s in zip(where, no, d.argmin(axis=1), letters, sure, sentence):
                        if n:
                            out[0][i][index[best]] += int(n)
                        if s and n >= MIN_LETTERS and c >= MARGIN:
                            out[1][i].append(k)
                            out[2][i].append(index[best])
                            out[3][i].append(round(float(c), 4))
                yield pd.DataFrame({"md5": pdf["md5"].to_numpy(), "chunk_id": pdf["chunk_id"].to_numpy(), "letters": out[0], "block_no": out[1], "tag": out[2], "confidence": out[3]})

    return chunks.select("md5", "chunk_id", "content").where("content is not null and md5 is not null").mapInPandas(run, schema)


def names_language(label, tag):
    """Whether a label, also a packed one, names ``tag`` in some notation."""
    parts = F.transform(F.split(F.lower(F.coalesce(label, F.lit(""))), "[,;/]"), lambda x: F.trim(x))
    fits = F.lit(False)
    for t in TAGS:
        names = [*NOTATIONS[t], *(TATAR if t == "tt-Cyrl" else ())]
        fits = F.when(tag == t, F.arrays_overlap(parts, F.array(*map(F.lit, names)))).otherwise(fits)
    return fits


def identify(chunks: DataFrame, catalog: DataFrame) -> DataFrame:
    """``md5, chunk_id, block_no, lang_tag, confidence, label_ok``.

    With ``chunk_id`` = ``block_no`` = -1 one row for each record with text: its main language, the one with most
    letters, ties going to the first of ``TAGS``; ``label_ok`` tells whether the record's label names it. Else one row
    for each block whose sentences are in another language. Records without readable text give no row; repeated chunks
    count each time; columns beside ``md5, chunk_id, content, language`` are not read.
    """
    rows = written(votes(chunks, fit(chunks, catalog)), "langid")
    sums = rows.groupBy("md5").agg(*[F.sum(F.col("letters")[k]).alias(f"n{k}") for k in range(len(TAGS))])
    total = sum((F.col(f"n{k}") for k in range(1, len(TAGS))), F.col("n0"))
    most = F.greatest(*[F.col(f"n{k}") for k in range(len(TAGS))])
    main = sums.where(total > 0).select("md5", F.coalesce(*[F.when(F.col(f"n{k}") == most, F.lit(k)) for k in range(len(TAGS))]).alias("main"), F.round(most / total, 4).alias("confidence"))
    tag = lambda c: F.element_at(F.array(*map(F.lit, TAGS)), c + 1)
    labels = catalog.select("md5", "language").dropDuplicates(["md5"])
    records = main.join(labels, "md5", "left").select("md5", F.lit(-1).cast("bigint").alias("chunk_id"), F.lit(-1).alias("block_no"), tag(F.col("main")).alias("lang_tag"), "confidence", names_language(F.col("language"), tag(F.col("main"))).alias("label_ok"))
    mixed = rows.where(F.size("tag") > 0).select("md5", "chunk_id", F.arrays_zip("block_no", "tag", "confidence").alias("b"))
    passages = (
        mixed.join(main.select("md5", "main"), "md5")
        .select("md5", "chunk_id", F.explode(F.filter("b", lambda x: x["tag"] != F.col("main"))).alias("b"))
        .select("md5", "chunk_id", F.col("b.block_no").alias("block_no"), tag(F.col("b.tag")).alias("lang_tag"), F.col("b.confidence").alias("confidence"), F.lit(False).alias("label_ok"))
    )
    return records.unionByName(passages)


def found(chunks: DataFrame, catalog: DataFrame) -> DataFrame:
    """Records with a missing or wrong label, and foreign passages."""
    return identify(chunks, catalog).where("not label_ok").select("md5", "chunk_id", "block_no", "lang_tag")
