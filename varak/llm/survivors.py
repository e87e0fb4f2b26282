"""The best representative of each group of records of one book, by token-level consensus.

The distinct values of each field are put into one alignment progressively, heaviest first; weighted tokens vote in
each column, and the existing value closest to the consensus stands for the field. The marks of trust (complete, PDF,
content filled) are fields of the same profile, where a trusted value outvotes all others. The surviving record is the
one closest to the consensus, first in the marks, then in the tokens, then the latest.

A group of up to ``BLOCK`` records is one block and settled where its rows meet. Larger ones are aligned in blocks,
whose profiles are aligned in turn, so a group of any size is reduced step by step and never collected.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varak.operators.packed import isbn_key
from varak.sources.tables import discard, written

TEXTS = ("title", "author", "publisher", "publish_date", "language", "genre")
#: Fields of the consensus; ``content_url`` is voted on as a whole, as parts of links can't be mixed.
FIELDS = (*TEXTS, "is_full", "mime_type", "content_url")
PDF = ("application/pdf", "application/x-pdf")
BLOCK = 32
CELLS = 1 << 20  # scores of an alignment that are kept at a time; more are computed again
MANY = 64  # places of a token from which they are scored as an array
GAP = ""
#: For each column the weight of its tokens; between Python and Spark it travels as JSON.
Profile = list[dict[str, float]]


def tokens(value: str) -> list[str]:
    return value.split()


def profile_of(value: str, weight: float) -> Profile:
    return [{t: weight} for t in tokens(value)]


def align(a: Profile, b: Profile) -> Profile:
    """Two profiles in one: columns meet where their tokens agree most, gaps carry the weight of what lacks the column.

    Columns without a common token share one where nothing else stands between, so a profile stays as long as its
    longest value.
    """
    wa = max((sum(c.values()) for c in a), default=0.0)
    wb = max((sum(c.values()) for c in b), default=0.0)
    same = _same(a, b)
    pairs = [*zip(range(same), range(same)), *((same + i if i >= 0 else -1, same + j if j >= 0 else -1) for i, j in _path(a[same:], b[same:], max(wa * wb, 1e-9)))]
    out: Profile = []
    for i, j in pairs:
        left, right = a[i] if i >= 0 else {GAP: wa}, b[j] if j >= 0 else {GAP: wb}
        out.append({t: left.get(t, 0.0) + right.get(t, 0.0) for t in {*left, *right}})
    return out


def _same(a: Profile, b: Profile) -> int:
    """Columns at the start that meet in a best alignment, as neither of two agrees more with any other column."""
    tops: list[dict[str, float]] = [{}, {}]
    for top, p in zip(tops, (a, b)):
        for c in p:
            for t, w in c.items():
                top[t] = max(top.get(t, 0.0), w) if t != GAP else 0.0
    agree = lambda x, y: sum(w * y.get(t, 0.0) for t, w in x.items() if t != GAP)
    for k, (x, y) in enumerate(zip(a, b)):
        if agree(x, y) < max(agree(x, tops[1]), agree(y, tops[0])):
            return k
    return min(len(a), len(b))


def _path(a: Profile, b: Profile, whole: float) -> list[tuple[int, int]]:
    """The columns that meet in the best alignment, -1 for none.

    Rows of scores beyond ``CELLS`` are computed again when the path gets there, halves of halves, so memory stays in
    proportion to the columns.
    """
    n, m = len(a), len(b)
    if not n or not m:
        return [*((i, -1) for i in range(n)), *((-1, j) for j in range(m))]
    where: dict[str, list[tuple[int, float]]] = defaultdict(list)
    for j, c in enumerate(b):
        for t, w in c.items():
            if t != GAP:
                where[t].append((j, w))
    many = {t: (np.array([j for j, _ in x]), np.array([w for _, w in x])) for t, x in where.items() if len(x) > MANY}

    def like(i: int, first: int) -> np.ndarray:
        row = np.zeros(m)
        for t, w in a[i].items():
            if t in many:
                row[many[t][0]] += w * many[t][1] / whole
            else:
                for j, v in where.get(t, ()):
                    row[j] += w * v / whole
        return row[first:]

    def above(below: np.ndarray, likes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(below))
        out[:-1] = np.maximum.accumulate(np.maximum(below[:-1], below[1:] + likes)[::-1])[::-1]
        return out

    out: list[tuple[int, int]] = []
    j, parts = 0, [(0, n, np.zeros(m + 1))]  # rows still to walk through, the scores below them
    while parts:
        lo, hi, below = parts.pop()
        first, below = j, below[len(below) - (m + 1 - j) :]
        if hi - lo > 1 and (hi - lo) * len(below) > CELLS:
            mid, row = (lo + hi) // 2, below
            for i in range(hi - 1, mid - 1, -1):
                row = above(row, like(i, first))
            parts += [(mid, hi, below), (lo, mid, row)]
            continue
        likes, score = [like(i, first) for i in range(lo, hi)], [below]
        for x in reversed(likes):
            score.append(above(score[-1], x))
        score.reverse()
        i = lo
        while i < hi:
            now, then, k = score[i - lo], score[i - lo + 1], j - first
            if j < m and now[k] == then[k + 1] + likes[i - lo][k]:
                out.append((i, j))
                i, j = i + 1, j + 1
            elif j == m or now[k] == then[k]:
                out.append((i, -1))
                i += 1
            else:
                out.append((-1, j))
                j += 1
    return [*out, *((-1, k) for k in range(j, m))]


def consensus(profile: Profile) -> list[str]:
    """The winning token of each column; ties go to a token before a gap, then to the first in order."""
    winners = (min(c, key=lambda t: (-c[t], t == GAP, t)) for c in profile)
    return [t for t in winners if t != GAP]


def distance(values: list[str], target: list[str]) -> int:
    """Tokens to insert or delete to get from one list to the other."""
    if values == target:
        return 0
    places: dict[str, int] = defaultdict(int)
    for j, u in enumerate(target):
        places[u] |= 1 << j
    every = free = (1 << len(target)) - 1  # a bit for each token of the target, off where the common part grows
    for t in values:
        met = free & places.get(t, 0)
        free = (free + met | free - met) & every
    return len(values) + len(target) - 2 * (len(target) - free.bit_count())


def merged(parts: list[Profile]) -> Profile:
    """Aligns profiles, the heaviest first; equally heavy ones in the order of their tokens."""
    parts = sorted(parts, key=lambda p: (-max((sum(c.values()) for c in p), default=0.0), [sorted(c) for c in p]))
    whole = parts[0] if parts else []
    for p in parts[1:]:
        whole = align(whole, p)
    return whole


def votes(records: list[dict], n: int) -> dict[str, dict[str, float]]:
    """Weight of each value of each field among distinct records of a group of ``n``; blank values don't vote.

    A record weighs more the more trusted it is, and a trusted value (complete, PDF) more than all others of the group.
    """
    out: dict[str, dict[str, float]] = {f: defaultdict(float) for f in FIELDS}
    for r in records:
        weight = 1.0 + 2 * r["f"] + r["p"] + r["c"]
        for f in FIELDS:
            if r[f] is not None:
                out[f][r[f]] += weight + 5.0 * n * (f == "is_full" and r["f"] or f == "mime_type" and r["p"])
    return out


def profiles(values: dict[str, dict[str, float]]) -> dict[str, Profile]:
    return {f: merged([profile_of(v, w) for v, w in values[f].items()]) for f in FIELDS if f != "content_url" and values[f]}


def apart(record: dict, target: dict[str, list[str]], url: bool) -> tuple[int, int]:
    """How far a record is from the consensus: trust marks it lacks, then tokens."""
    behind = (record["is_full"] or "") != " ".join(target.get("is_full", []))
    behind += bool(record["p"]) != (" ".join(target.get("mime_type", [])) in PDF)
    behind += bool(record["c"]) != url
    return behind, sum(distance(tokens(record[f] or ""), target.get(f, [])) for f in TEXTS)


def _best(record: dict, target: dict[str, list[str]], url: bool) -> tuple:
    return *apart(record, target, url), -record["at"], record["md5"]


def settled(records: list[dict]) -> dict:
    """The result of a group whose records are all at hand."""
    values = votes(records, len(records))
    target = {f: consensus(p) for f, p in profiles(values).items()}
    keys = [_best(r, target, bool(values["content_url"])) for r in records]
    near = {f: min(((distance(tokens(v), target[f]) if f in target else 0, -w, v) for v, w in values[f].items()), default=(0, 0, None))[2] for f in FIELDS}
    return {"md5": min(keys)[3], "n_records": len(records), "beats_all": sum(k[0] == 0 for k in keys) == 1, **near}


_INPUT = ["isbn_key", "n", "block", "md5", "f", "p", "c", "at", *FIELDS]
_RESULT = "isbn_key string, md5 string, n_records bigint, beats_all boolean, " + ", ".join(f"{f} string" for f in FIELDS)
_PART = f"{_RESULT}, block bigint, profile string"
_NAMES = [x.split()[0] for x in _PART.split(", ")]


def _blocks(batches: Iterator[pd.DataFrame], fn) -> Iterator[pd.DataFrame]:
    """Calls ``fn(key, n, block, distinct records)`` for each block of sorted rows; a block may go on in the next batch."""
    waiting: list[tuple] = []

    def ready() -> list:
        records = {r[3]: dict(zip(_INPUT[3:], r[3:])) for r in waiting}  # a repeated record counts once
        return fn(*waiting[0][:3], list(records.values()), waiting[0][len(_INPUT) :]) if waiting else []

    for pdf in batches:
        done = []
        columns = [*_INPUT, *(c for c in pdf.columns if c not in _INPUT)]
        for row in pdf[columns].astype(object).where(pdf[columns].notna(), None).itertuples(index=False, name=None):
            if waiting and (waiting[-1][0], waiting[-1][2]) != (row[0], row[2]):
                done += ready()
                waiting = []
            waiting.append(row)
        yield done
    yield ready()


def _first(size: int):
    """The result of groups of one block of ``size``, the profile of each block of the others."""

    def one(key: str, n: int, block: int, records: list[dict], _) -> list[dict]:
        if n <= size:
            return [{"isbn_key": key, **settled(records)}] if len(records) > 1 else []
        return [{"isbn_key": key, "block": block, "profile": _text(profiles(votes(records, n)))}]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for done in _blocks(batches, one):
            yield pd.DataFrame(done, columns=_NAMES, dtype=object)

    return run


def _text(whole: dict[str, Profile]) -> str:
    return json.dumps({f: [dict(sorted(c.items())) for c in p] for f, p in whole.items()}, ensure_ascii=False)


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for parts in pdf["parts"]:
            ready = [json.loads(p) for p in parts]
            out.append(_text({f: merged([p[f] for p in ready if f in p]) for f in FIELDS if any(f in p for p in ready)}))
        yield pdf[["isbn_key", "block"]].assign(profile=out)


_JUDGED = "isbn_key string, n_records bigint, closest bigint, best struct<behind:int,far:int,ago:bigint,md5:string>, vals array<struct<field:string,value:string,far:int,weight:double>>"


def _judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per block of a large group: its closest record, how many lack no mark, and how far its values are."""

    def one(key: str, n: int, block: int, records: list[dict], more: tuple) -> list[dict]:
        target = {f: consensus(p) for f, p in json.loads(more[0]).items()}
        keys = [_best(r, target, bool(more[1])) for r in records]
        vals = [{"field": f, "value": v, "far": distance(tokens(v), target[f]) if f in target else 0, "weight": w} for f, x in votes(records, n).items() for v, w in x.items()]
        return [{"isbn_key": key, "n_records": len(records), "closest": sum(k[0] == 0 for k in keys), "best": dict(zip(("behind", "far", "ago", "md5"), min(keys))), "vals": vals}]

    for done in _blocks(batches, one):
        yield pd.DataFrame(done, columns=["isbn_key", "n_records", "closest", "best", "vals"], dtype=object)


def filled(c: str) -> F.Column:
    return F.coalesce(F.trim(c) != "", F.lit(False))


def records(catalog: DataFrame) -> DataFrame:
    """Records with ISBNs and the key of their group, trust marks and fields; blank fields and "unknown" are null."""
    known = lambda c: F.when(filled(c) & (F.lower(F.trim(c)) != "unknown"), F.regexp_replace(F.trim(c), r"\s+", " "))
    mime = F.lower(F.trim("mime_type"))
    out = catalog.select(
        isbn_key(F.col("isbn")).alias("isbn_key"), "md5", F.coalesce("is_full", F.lit(False)).cast("int").alias("f"), F.coalesce(mime.isin(*PDF), F.lit(False)).cast("int").alias("p"),
        filled("content_url").cast("int").alias("c"), F.coalesce(F.unix_micros(F.col("updated_at").cast("timestamp")), F.lit(-1)).alias("at"), *[known(x).alias(x) for x in TEXTS],
        F.coalesce("is_full", F.lit(False)).cast("string").alias("is_full"), F.when(mime != "", mime).alias("mime_type"), F.when(filled("content_url"), F.trim("content_url")).alias("content_url"),
    )
    return out.where("isbn_key <> '' and md5 is not null")


def survivors(catalog: DataFrame) -> DataFrame:
    """One row for each group of two or more records with the same set of ISBNs.

    ``isbn_key, md5, n_records, beats_all`` and the consensus value of each field; ``md5`` is the surviving record, the
    one closest to the consensus, and ``beats_all`` tells that it alone lacks none of the marks of trust that the
    consensus has: it is behind each other record on none and ahead on one at least. Records without ISBN are in no
    group; repeated records count once; fields without any value are null; other columns are not read.
    """
    stored = written(records(catalog), "survivor-records")
    sizes = stored.groupBy("isbn_key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = stored.join(sizes, "isbn_key").withColumn("block", F.pmod(F.xxhash64("md5"), F.ceil(F.col("n") / BLOCK))).select(*_INPUT)
    met = lambda df: df.repartition("isbn_key", "block").sortWithinPartitions("isbn_key", "block")
    parts = written(met(blocks).mapInPandas(_first(BLOCK), _PART), "survivor-parts")
    done = parts.where("block is null").drop("block", "profile").withColumn("is_full", F.col("is_full").cast("boolean"))
    most = parts.agg(F.max("block")).first()[0]
    if most is None:
        discard(stored)
        return done
    tops, left = parts.where("block is not null").select("isbn_key", "block", "profile"), most + 1
    while left > 1:
        tops = tops.groupBy("isbn_key", F.floor(F.col("block") / BLOCK).alias("block")).agg(F.collect_list("profile").alias("parts")).mapInPandas(_merge, "isbn_key string, block bigint, profile string")
        left = -(-left // BLOCK)
    whole = tops.select("isbn_key", "profile").join(stored.groupBy("isbn_key").agg((F.max("c") > 0).alias("url")), "isbn_key")
    large = blocks.where(F.col("n") > BLOCK).join(whole, "isbn_key")
    judged = written(met(large).mapInPandas(_judged, _JUDGED), "survivor-judged")
    chosen = judged.groupBy("isbn_key").agg(F.min("best")["md5"].alias("md5"), F.sum("n_records").alias("n_records"), (F.sum("closest") == 1).alias("beats_all"))
    values = judged.select("isbn_key", F.explode("vals").alias("v")).groupBy("isbn_key", "v.field", "v.value").agg(F.min("v.far").alias("far"), F.sum("v.weight").alias("weight"))
    near = values.groupBy("isbn_key").agg(*[F.min(F.when(F.col("field") == f, F.struct("far", -F.col("weight"), "value")))["value"].alias(f) for f in FIELDS])
    rest = chosen.where("n_records > 1").join(near, "isbn_key").withColumn("is_full", F.col("is_full").cast("boolean"))
    return done.unionByName(rest.select(*done.columns))


def found(catalog: DataFrame) -> DataFrame:
    """Groups in which one record beats each other one, with that record."""
    return survivors(catalog).where("beats_all").select("isbn_key", "md5")
