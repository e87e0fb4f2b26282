"""Held-out test items inside corpus documents, by size-partitioned MinHash containment search.

Documents are read as windows of five-word shingles, one window size for each size class of the items, so that a short
item meets windows of its own size inside a long document. Item and window share a MinHash slot with a probability of
their resemblance; every item met in a slot is a candidate, which exact shingle containment and then an in-order
alignment of the words confirm or refuse.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
SLOTS = 48
LEAST = 0.5  # share of an item's words that a document holds in one stretch
#: Items broadcast at once; more are searched in further passes, so the bound drops nothing.
BLOCK_ITEMS = 20_000
BITS = 22
BATCH = 400  # documents hashed together

_WORD = re.compile(r"[^\W_]+")
_WRAP = re.compile(r"(?<=\w)[-‐¬­]\s*\n\s*(?=\w)")
_RNG = np.random.default_rng(20_240_501)
_MUL = _RNG.integers(1, 2**63, SLOTS, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(0, 2**63, SLOTS, dtype=np.uint64)


def words(text: str | None) -> list[str]:
    """Lower-case words without punctuation and Markdown marks; words cut at a line's end are put together."""
    if not text:
        return []
    t = text if text.isascii() or unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)
    if "\n" in t:
        t = _WRAP.sub("", t)
    return _WORD.findall(t.replace("\u00ad", "").lower().replace("ё", "е"))


def _shingles(ids: np.ndarray) -> np.ndarray:
    """Hashes of the runs of ``SHINGLE`` words; shorter texts have one of all their words."""
    n = max(1, len(ids) - SHINGLE + 1)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(SHINGLE, len(ids))):
            out = out * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + n]
            out ^= out >> np.uint64(29)
    return out


def _mins(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash slots of consecutive segments: one row for each segment."""
    with np.errstate(over="ignore"):
        out = np.empty((len(starts), SLOTS), dtype=np.uint64)
        for k in range(SLOTS):
            h = values * _MUL[k] + _ADD[k]
            out[:, k] = np.minimum.reduceat(h, starts)
    return out


class _Ids:
    """64-bit hashes of words, kept for the words seen so far."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def of(self, ws: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > 1_000_000:
            known.clear()
        for w in set(ws).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, ws), dtype=np.uint64, count=len(ws))


class Index:
    """Items in size classes, each class with its MinHash slots."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.ids = _Ids()
        self.words: list[list[int]] = []
        self.keys: list[int] = []
        self.sets: list[np.ndarray] = []
        self.slots: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        self.filter: dict[int, np.ndarray] = {}
        for key, text in items:
            ws = words(text)
            if len(ws) < 2:
                continue
            ids = self.ids.of(ws)
            sh = np.unique(_shingles(ids))
            k = len(self.keys)
            self.keys.append(key)
            self.words.append(ids.tolist())
            self.sets.append(sh)
            size = 1 << max(3, (len(ws) - 1).bit_length() - 1)  # windows of half the largest item of the class
            # an item is sketched as a whole and by halves, as a document may hold only a part of it
            half = max(1, len(ws) // 2)
            raw = _shingles(ids)
            parts = [raw, raw[:half], raw[-half:]]
            for part in parts:
                for slot, v in enumerate(_mins(part, np.array([0]))[0].tolist()):
                    bucket = self.slots[size][(v ^ slot) & 0xFFFFFFFFFFFFFFFF]
                    if k not in bucket:
                        bucket.append(k)
        self.bitmap: dict[int, np.ndarray] = {}
        for size, table in self.slots.items():
            self.filter[size] = np.sort(np.fromiter(table, dtype=np.uint64, count=len(table)))
            self.bitmap[size] = np.zeros(1 << BITS, dtype=bool)
            self.bitmap[size][self.filter[size] >> np.uint64(64 - BITS)] = True

    def candidates(self, sh: list[np.ndarray]) -> set[tuple[int, int]]:
        """Pairs of a document's number and an item that share a slot in some window of the document's shingles."""
        found: set[tuple[int, int]] = set()
        if not sh:
            return found
        length = np.array([len(x) for x in sh])
        offset = np.cumsum(length) - length
        values = np.concatenate(sh)
        for size, table in self.slots.items():
            # blocks of half a window; a window's slots are the smaller ones of two neighbouring blocks
            step = max(1, size // 2)
            blocks = np.maximum(1, length // step)
            doc = np.repeat(np.arange(len(sh)), blocks)
            starts = offset[doc] + step * (np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
            next_ = np.flatnonzero(doc[1:] == doc[:-1])
            with np.errstate(over="ignore"):
                for k in range(SLOTS):
                    low = np.minimum.reduceat(values * _MUL[k] + _ADD[k], starts)
                    for keys, of in ((low, doc), (np.minimum(low[next_], low[next_ + 1]), doc[next_])):
                        keys = keys ^ np.uint64(k)
                        hit = np.flatnonzero(self.bitmap[size][keys >> np.uint64(64 - BITS)])
                        for d, v in zip(of[hit].tolist(), keys[hit].tolist()):
                            found.update((d, i) for i in table.get(v, ()))
        return found

    def holds(self, ids: np.ndarray, sh: np.ndarray, k: int) -> bool:
        """Exact check: shared shingles place the item, then its words are aligned in order around that place."""
        item = self.words[k]
        at = np.flatnonzero(np.isin(sh, self.sets[k]))
        if len(at) < min(2, len(self.sets[k])):  # half of an item with a few changed words keeps more than one
            return False
        need = max(2, -(-len(item) // 2)) if LEAST == 0.5 else max(2, int(np.ceil(LEAST * len(item))))
        reach = len(item)
        doc = ids.tolist()
        done = -1
        for p in at.tolist():
            if p < done:
                continue
            # one stretch: the words about this place, not farther apart than the item is long
            lo, hi = max(0, p - reach), min(len(doc), p + SHINGLE + reach)
            done = p + max(1, reach // 3)
            if _stretch(item, doc[lo:hi], need):
                return True
        return False


def _stretch(item: list[int], doc: list[int], need: int) -> bool:
    """Whether some stretch of the document holds ``need`` of the item's words in order, with few words between."""
    if _lcs(item, doc) < need:
        return False
    where: dict[int, list[int]] = defaultdict(list)
    for j, w in enumerate(item):
        where[w].append(j)
    # a stretch follows one diagonal: insertions and omissions shift it only a little
    diagonal: dict[int, int] = defaultdict(int)
    met = [0]
    for i, w in enumerate(doc):
        met.append(met[-1] + (w in where))
        for j in where.get(w, ()):
            diagonal[i - j] += 1
    tried: set[tuple[int, int]] = set()
    for d in sorted(diagonal, key=lambda x: -diagonal[x]):
        a, b = max(0, d - 3), min(len(doc), d + len(item) + 3)
        if met[b] - met[a] < need or (a, b) in tried:  # too few of its words for any order
            continue
        tried.add((a, b))
        if _lcs(item, doc[a:b]) >= need:
            return True
    return False


def _lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, with the rows of the table as bits of one integer."""
    masks: dict[int, int] = defaultdict(int)
    for i, w in enumerate(a):
        masks[w] |= 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        m = masks.get(w, 0)
        u = v & m
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def found(documents: DataFrame, items: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """``doc_id, item_id``: documents that hold at least half of an item's words in one stretch, in order.

    Null and empty texts match nothing, items of one word are left out, equal items are each reported, repeated
    documents are reported each time. Items are broadcast in blocks of ``BLOCK_ITEMS``; documents are read in place and
    never shuffled.
    """
    n_blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    out = None
    for b in range(n_blocks):
        part = items.select("item_id", "item_text").where("item_text is not null").where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == b)
        rows = [(r.item_id, r.item_text) for r in part.collect()]
        one = _scan(documents, rows, key, column)
        out = one if out is None else out.unionByName(one)
    return out


def _scan(documents: DataFrame, rows: list[tuple[int, str]], key: str, column: str) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(rows)  # BLOCK_ITEMS items at most
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(shared.value)
        for pdf in batches:
            out = []
            for lo in range(0, len(pdf), BATCH):
                keys, ids = [], []
                for k, t in zip(pdf["k"].iloc[lo : lo + BATCH], pdf["t"].iloc[lo : lo + BATCH]):
                    if index.keys and len(ws := words(t)) > 1:
                        keys.append(k)
                        ids.append(index.ids.of(ws))
                sh = [_shingles(x) for x in ids]
                out.extend((keys[d], index.keys[i]) for d, i in sorted(index.candidates(sh)) if index.holds(ids[d], sh[d], i))
            yield pd.DataFrame(out, columns=["k", "item_id"])

    source = documents.select(F.col(key).alias("k"), F.col(column).alias("t")).where("t is not null and t <> ''")
    return source.mapInPandas(run, f"k {kind}, item_id bigint").withColumnRenamed("k", key)
