"""Subjects of documents: bisecting k-means over document vectors, labelled leaves, leaf mixtures.

Documents become normalised vectors: weighted word beginnings in ``WIDTH`` signed slots. A tree of bisections is grown
and refined over all documents, which go down the tree in every pass. A leaf is labelled by the subjects that hand-set
labels and readable genres give to its documents. The leaves of one label and language pool their terms, and what tells
the pools of a language apart are the discriminative terms of their leaves. Each sentence goes to the pool that its
terms speak for, so a document is a mixture of leaves and has the subjects that hold enough of its sentences.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varak.llm import leaks
from varak.sources.tables import discard, written

DIMS = 1 << 14  # slots of terms
WIDTH, SIGNS = 512, 2  # numbers of a document vector, and how many of them a term enters
#: Documents for each leaf that give the starting centres of its bisections, and passes over all documents that follow.
START_DOCS, REFINE = 40, 2
FANOUT = 24  # how many times more leaves a round makes
#: Share among the sentences that speak for a subject. About a fifth of all sentences speak for none, so this is a fifth
#: of all; a subject met in one sentence needs ``SINGLE``.
SHARE, SINGLE = 0.24, 0.3
#: A subject that is told by one of so many of all sentences always counts; the shares above only read the silent ones.
ONE_OF = 5
PURE = 0.7  # share of its told sentences from which a document teaches the terms of one subject
COMMON = 256  # most frequent terms, by which leaves of one language are known
LABEL_WEIGHT = 4.0  # a label set by hand counts as so many genres
SHARPER = 4  # power that makes a leaf's label of its noisy votes
SURE = 1.5  # log odds from which a sentence speaks for a subject

#: Genres that name a subject, folded to lower case (fixed values); all others are too vague.
GENRES = {
    "science": "science наука естествознание physics физика chemistry химия biology биология фән «chemistry textbook»",
    "history": "history история тарих chronicle «historical essay»",
    "law": "law право хокук «legal code» «юридическая литература» хоҡуҡ",
    "sport": "sport спорт wrestling «sports manual» физкультура көрәш",
    "software": "software «computer science» информатика программалау «user manual» программирование",
    "medicine": "medicine медицина health сәламәтлек pharmacology",
    "farming": "farming agriculture «авыл хуҗалыгы» «сельское хозяйство» gardening",
    "fiction": "fiction novel «short stories» проза повесть хикәя роман poetry поэзия",
    "religion": "religion «religious text» «prayer book» дин ислам религия islam",
    "music": "music музыка songbook җырлар «sheet music» йырҙар",
}
_GENRE = {g.strip("«»"): s for s, text in GENRES.items() for g in re.findall(r"«[^»]+»|\S+", text)}

_SENTENCE = re.compile(r"(?<=[.!?…])[\"»)]*\s+|\n\s*\n")
_WORD = re.compile(r"[^\W\d_]+")
_MASK = DIMS - 1


def _term(word: str) -> int:
    import xxhash

    return xxhash.xxh32_intdigest(word[:5]) & _MASK


class _Terms(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = t = _term(word)
        return t


def sentences(text: str) -> list[list[str]]:
    """Words of each sentence; headings are none, words cut at a line's end are put together."""
    t = leaks._WRAP.sub("", text) if "\n" in text else text
    return [ws for s in _SENTENCE.split(t) if s and not s.lstrip().startswith("#") and len(ws := _WORD.findall(s.lower())) > 2]


def copied(sents: list[list[str]], ids: leaks._Ids, known: np.ndarray) -> list[bool]:
    """Which sentences lie in a stretch copied from the test items: six of its shingles or more, close together."""
    if not len(known) or not sents:
        return [False] * len(sents)
    flat = [w.replace("ё", "е") for s in sents for w in s]
    sh = leaks._shingles(ids.of(flat))
    at = np.searchsorted(known, sh)
    at[at == len(known)] = 0
    hits = np.flatnonzero(known[at] == sh)
    if len(hits) < 6:
        return [False] * len(sents)
    inside = np.zeros(len(flat), dtype=bool)
    for run in np.split(hits, np.flatnonzero(np.diff(hits) > 12) + 1):
        if len(run) >= 6:
            inside[run[0] : run[-1] + leaks.SHINGLE] = True
    ends = np.cumsum([len(s) for s in sents])
    return [bool(inside[e - len(s) : e].mean() > 0.5) for s, e in zip(sents, ends)]


def item_texts(items: DataFrame) -> Iterator[list[str]]:
    """All texts of the test items in blocks of about ``leaks.BLOCK_ITEMS``; at least one block, which may be empty."""
    texts = items.select("item_text").where("item_text is not null")
    n = max(1, -(-texts.count() // leaks.BLOCK_ITEMS))
    for k in range(n):
        yield [r.item_text for r in texts.where(F.pmod(F.xxhash64("item_text"), F.lit(n)) == k).collect()]


def vectors(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Terms of each document's own sentences: ``doc_id, md5, terms, lengths, units``, the last with each term once.

    Items come in blocks, each block marking the sentences that are copied from it: a chain of narrow maps.
    """
    spark = documents.sparkSession
    rows = documents.select("doc_id", "md5", "text", F.lit(None).cast("array<int>").alias("out")).where("text is not null and text <> ''")
    blocks = [spark.sparkContext.broadcast(b) for b in item_texts(items)]
    for b in blocks[:-1]:
        rows = rows.mapInArrow(_marker(b), "doc_id bigint, md5 string, text string, out array<int>")
    shared = blocks[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, terms, known = leaks._Ids(), _Terms(), _known(shared.value)
        for b in batches:
            flat, lengths, n_terms, n_sents = [], [], [0], [0]
            for text, out in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                sents = sentences(text)
                gone = {*(out or ()), *_copies(sents, ids, known)}
                for k, s in enumerate(sents):
                    if k not in gone:
                        own = [terms[w] for w in s if len(w) > 2]
                        flat += own
                        lengths.append(len(own))
                n_terms.append(len(flat))
                n_sents.append(len(lengths))
            n = np.diff(n_terms)
            key = np.unique(np.repeat(np.arange(len(n)), n) * DIMS + np.array(flat, dtype=np.int64))
            at = np.searchsorted(key, np.arange(len(n) + 1) * DIMS)
            lists = [pa.ListArray.from_arrays(pa.array(np.asarray(o, dtype=np.int32)), pa.array(np.asarray(v, dtype=np.int32))) for o, v in ((n_terms, flat), (n_sents, lengths), (at, key % DIMS))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *lists], names=["doc_id", "md5", "terms", "lengths", "units"])

    return rows.mapInArrow(run, "doc_id bigint, md5 string, terms array<int>, lengths array<int>, units array<int>")


def _known(texts: list[str]) -> np.ndarray:
    """Shingles of the test items, sorted."""
    ids = leaks._Ids()
    parts = [leaks._shingles(ids.of(ws)) for t in texts if len(ws := [w.replace("ё", "е") for s in sentences(t) for w in s]) > 1]
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


def _copies(sents: list[list[str]], ids: leaks._Ids, known: np.ndarray) -> list[int]:
    return [k for k, c in enumerate(copied(sents, ids, known)) if c]


def _marker(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, known = leaks._Ids(), _known(shared.value)
        for b in batches:
            out = [[*(old or ()), *_copies(sentences(t), ids, known)] for t, old in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.list_(pa.int32()))], names=["doc_id", "md5", "text", "out"])

    return run


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values and row lengths of a list column."""
    c = batch.column(batch.schema.get_field_index(name))
    offsets = c.offsets.to_numpy(zero_copy_only=False)
    return c.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], np.diff(offsets)


_RNG = np.random.default_rng(11)
_SLOT = _RNG.integers(0, WIDTH, (SIGNS, DIMS))
_SIGN = _RNG.choice([-1.0, 1.0], (SIGNS, DIMS))
_SCALE = 360.0  # a number of a unit vector as a signed byte; those beyond 0.35 are cut


def dense(units: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of documents that hold each term once; a document without terms is all zeros."""
    at, w = np.repeat(np.arange(len(n)) * WIDTH, n), idf[units]
    x = np.zeros(len(n) * WIDTH)
    for slot, sign in zip(_SLOT, _SIGN):
        x += np.bincount(at + slot[units], weights=w * sign[units], minlength=len(x))
    x = x.reshape(len(n), WIDTH).astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _packed(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.clip(np.rint(x * _SCALE), -127, 127).astype(np.int8)], pa.binary())


def _unpacked(c: pa.Array) -> np.ndarray:
    if not len(c):
        return np.zeros((0, WIDTH), np.float32)
    first = np.frombuffer(c.buffers()[1], np.int32)[c.offset]
    x = np.frombuffer(c.buffers()[2], np.int8)[first : first + len(c) * WIDTH].reshape(len(c), WIDTH).astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


class Tree:
    """A bisection tree: node k has the children ``left[k]`` and ``left[k] + 1``, or is a leaf."""

    def __init__(self, left: list[int], centers: np.ndarray) -> None:
        self.left, self.centers = np.asarray(left), np.asarray(centers, dtype=np.float32)
        at = np.maximum(self.left, 0)
        self.side = self.centers[np.minimum(at + 1, len(at) - 1)] - self.centers[at]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row, -1 for rows that are all zeros."""
        out = np.full(len(x), -1)
        for lo in range(0, len(x), 2000):
            part = x[lo : lo + 2000]
            node = np.zeros(len(part), dtype=np.int64)
            live = np.flatnonzero(self.left[node] >= 0)
            while len(live):
                at = node[live]
                node[live] = self.left[at] + (np.einsum("ij,ij->i", part[live], self.side[at]) > 0)
                live = live[self.left[node[live]] >= 0]
            out[lo : lo + 2000] = np.where(part.any(axis=1), node, -1)
        return out


def bisect(x: np.ndarray, leaves: int) -> tuple[list[int], list[np.ndarray]]:
    """``left`` and centres of a tree over unit vectors: the leaf of the widest spread is split by two-means each time."""
    rng = np.random.default_rng(7)
    spread = lambda m: len(m) - float(np.linalg.norm(x[m].sum(axis=0)))
    members, left, centers = {0: np.arange(len(x))}, [-1], [np.zeros(WIDTH, np.float32)]
    todo = {0: spread(members[0])}
    while len(members) < leaves and todo:
        k = max(todo, key=lambda n: (todo[n], -n))
        todo.pop(k)
        m = members[k]
        if len(m) < 5:
            continue
        best = None
        for _ in range(3):  # of three starts the tightest is kept
            a = x[m[rng.integers(len(m))]]
            two = np.stack([a, x[m[np.argsort(x[m] @ a, kind="stable")[rng.integers(max(1, len(m) // 4))]]]])
            for _ in range(8):
                side = x[m] @ (two[1] - two[0]) > 0
                if side.all() or not side.any():
                    break
                two = np.stack([x[m[~side]].sum(axis=0), x[m[side]].sum(axis=0)])
                two /= np.maximum(np.linalg.norm(two, axis=1, keepdims=True), 1e-9)
            if side.all() or not side.any():
                continue
            s = spread(m[~side]), spread(m[side])
            if best is None or sum(s) < sum(best[0]):
                best = s, two, side
        if best is None:
            continue
        s, two, side = best
        left[k] = len(left)
        members.pop(k)
        for c, part, v in zip(two, (m[~side], m[side]), s):
            members[len(left)], todo[len(left)] = part, v
            centers.append(c)
            left.append(-1)
    return left, centers


def wanted(n: float) -> int:
    """Leaves for a corpus of ``n`` documents: with its square root, up to what a pass can add up in memory."""
    return int(min(2048, 64 + 2.56 * math.sqrt(n)))


def grow(points: DataFrame, leaves: int | None = None) -> Tree:
    """Bisects over all documents, in rounds that make up to ``FANOUT`` times more leaves.

    ``points`` holds ``doc_id, point``. In a round each leaf gets new leaves in proportion to its spread over all
    documents; about ``START_DOCS`` of its documents for each give the starting centres, and ``REFINE`` passes move the
    new centres over all documents. A kind of document that a start misses widens its leaf, so the next round splits it.
    """
    sc = points.sparkSession.sparkContext
    rows = WIDTH + 1

    def measured(tree: Tree, rate: np.ndarray | None) -> tuple[np.ndarray, pd.DataFrame]:
        """Sums and counts of the leaves, and documents drawn with a leaf's ``rate``."""
        shared = sc.broadcast((tree, rate))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t, draw = shared.value
            total = np.zeros((len(t.left), rows))
            for b in batches:
                x = _unpacked(b.column(1))
                leaf = t.leaves(x)
                order = np.argsort(leaf, kind="stable")
                order = order[leaf[order] >= 0]
                first = np.flatnonzero(np.r_[True, np.diff(leaf[order]) > 0]) if len(order) else order
                if len(order):
                    total[leaf[order[first]], :WIDTH] += np.add.reduceat(x[order], first, axis=0)
                    total[leaf[order[first]], WIDTH] += np.diff(np.r_[first, len(order)])
                if draw is not None and len(order):
                    ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
                    ids = np.nan_to_num(ids).astype(np.int64).astype(np.uint64)
                    luck = ((ids ^ (ids >> np.uint64(7))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)) / 2.0**53
                    take = np.flatnonzero((leaf >= 0) & (luck < draw[leaf]))
                    yield _piece(leaf[take], pa.array(ids[take].astype(np.int64)), b.column(1).take(pa.array(take)))
            at = np.flatnonzero(total[:, WIDTH])
            yield _piece(at, pa.nulls(len(at), pa.int64()), pa.array([r.tobytes() for r in total[at]], pa.binary()))

        out = points.mapInArrow(run, "leaf int, doc_id bigint, x binary")
        if rate is not None:
            out = written(out, "subject-starts")
        parts = out.where("doc_id is null").repartition(4, "leaf").mapInArrow(_added, "leaf int, doc_id bigint, x binary").toPandas()
        sample = out.where("doc_id is not null").toPandas().sort_values(["leaf", "doc_id"]) if rate is not None else None
        if rate is not None:
            discard(out)
        shared.destroy()  # else every pass leaves its centres on disk
        total = np.zeros((len(tree.left), rows))
        for k, x in zip(parts["leaf"], parts["x"]):
            total[k] = np.frombuffer(x)
        return total, sample

    tree, closed = Tree([-1], np.zeros((1, WIDTH))), set()
    total, _ = measured(tree, None)
    n = total[0, WIDTH]
    leaves = leaves or wanted(n)
    while True:
        ends = np.flatnonzero(tree.left < 0)
        spread = np.array([total[k, WIDTH] - np.linalg.norm(total[k, :WIDTH]) for k in ends])
        spread[[k in closed for k in ends]] = 0
        spread[spread < 1e-6 * max(n, 1)] = 0
        room = min(leaves, FANOUT * len(ends))
        share = np.zeros(len(ends), dtype=int)
        if len(ends) < 0.9 * leaves and spread.sum() > 0:
            due = (room - len(ends)) * spread / spread.sum()
            share = 1 + np.floor(due).astype(int)
            rest = np.argsort(np.floor(due) - due, kind="stable")[: room - len(ends) - int(np.floor(due).sum())]
            share[rest] += 1  # the largest remainders
            share = np.where(spread > 0, np.minimum(share, total[ends, WIDTH] // 5).astype(int), 0)
        if not (share > 1).any():
            return tree
        rate = np.zeros(len(tree.left))
        rate[ends] = np.where(share > 1, START_DOCS * share / np.maximum(total[ends, WIDTH], 1), 0)
        _, sample = measured(tree, rate)
        left, centers = list(tree.left), list(tree.centers)
        for k, q in zip(ends, share):
            x = sample.loc[sample["leaf"] == k, "x"]
            sub, c = bisect(_unpacked(pa.array(list(x), pa.binary())), int(q)) if q > 1 and len(x) else ([-1], [])
            if len(sub) < 3:
                closed.add(k)
                continue
            base = len(left) - 1  # node j of the new tree becomes base + j, its root stays k
            left[k] = base + sub[0]
            left += [base + j if j >= 0 else -1 for j in sub[1:]]
            centers += c[1:]
        tree = Tree(left, np.stack(centers))
        for _ in range(REFINE):
            total, _ = measured(tree, None)
            for k in range(len(left) - 1, -1, -1):  # children stand behind their parents
                if left[k] >= 0:
                    total[k] = total[left[k]] + total[left[k] + 1]
            norm = np.linalg.norm(total[:, :WIDTH], axis=1, keepdims=True)
            tree = Tree(left, np.where(norm > 0, total[:, :WIDTH] / np.maximum(norm, 1e-9), tree.centers))


def _piece(leaf: np.ndarray, ids: pa.Array, x: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int32)), ids, x], names=["leaf", "doc_id", "x"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the vectors of each leaf."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for k, x in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            total[k] = total[k] + np.frombuffer(x) if k in total else np.frombuffer(x)
    yield _piece(np.array(list(total), dtype=np.int32), pa.nulls(len(total), pa.int64()), pa.array([v.tobytes() for v in total.values()], pa.binary()))


def _sums(rows: DataFrame, fn, schema: str, keys: list[str]) -> pd.DataFrame:
    """Runs ``fn`` over Arrow batches and adds up column ``x`` by ``keys``; the keys are bounded by nodes and terms."""
    return rows.mapInArrow(fn, schema).groupBy(*keys).agg(F.sum("x").alias("x")).toPandas()


def _tables(frame: pd.DataFrame, n: int, a: str, b: str = "term", width: int = DIMS) -> np.ndarray:
    out = np.zeros((n, width))
    out[frame[a].to_numpy(dtype=np.int64), frame[b].to_numpy(dtype=np.int64)] = frame["x"].to_numpy(dtype=float)
    return out


def _emit(names: tuple[str, str], table: np.ndarray) -> pa.RecordBatch:
    a, b = np.nonzero(table)
    return pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(table[a, b].astype(float))], names=[*names, "x"])


class Model:
    """Discriminative terms of the leaves of each subject."""

    def __init__(self, codes: list[str], odds: np.ndarray) -> None:
        self.codes, self.odds = codes, odds.astype(np.float32)

    def sentences(self, terms: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subject of each sentence, -1 where none is spoken for, and the log odds against the second."""
        if not len(lengths):
            self.best = np.empty(0, np.int64)
            return self.best, np.empty(0)
        at = np.repeat(np.arange(len(lengths)), lengths)
        score = np.stack([np.bincount(at, weights=self.odds[s, terms], minlength=len(lengths)) for s in range(len(self.codes))], axis=1)
        order = np.argsort(-score, axis=1, kind="stable")
        best = order[:, 0]
        margin = score[np.arange(len(best)), best] - (score[np.arange(len(best)), order[:, 1]] if score.shape[1] > 1 else 0)
        self.best = best  # also where it is unsure
        return np.where(margin >= SURE, best, -1), margin


def fit(rows: DataFrame, labels: DataFrame, catalog: DataFrame, codes: list[str]) -> tuple[DataFrame, Model]:
    """Documents with their leaf, and the model; ``rows`` are stored vectors, labels and genres name the leaves."""
    sc = rows.sparkSession.sparkContext

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1, DIMS + 1))
        for b in batches:
            units, _ = _lists(b, "units")
            total[0, :DIMS] += np.bincount(units, minlength=DIMS)
            total[0, DIMS] += b.num_rows
        yield _emit(("node", "term"), total)

    df = _tables(_sums(rows.select("units"), frequency, "node int, term int, x double", ["node", "term"]), 1, "node", width=DIMS + 1)[0]
    idf = np.log((df[DIMS] + 1) / (df[:DIMS] + 1)) * (df[:DIMS] > 1)
    common = np.argsort(-df[:DIMS], kind="stable")[:COMMON]
    rank = np.full(DIMS, -1)
    rank[common] = np.arange(COMMON)

    def pointed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _packed(dense(*_lists(b, "units"), idf))], names=["doc_id", "point"])

    points = written(rows.select("doc_id", "units").mapInArrow(pointed, "doc_id bigint, point binary"), "subject-points")
    tree = grow(points)
    discard(points)
    shared = sc.broadcast((tree, idf))  # 2 * wanted(n) nodes of WIDTH numbers

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, weights = shared.value
        for b in batches:
            units, n = _lists(b, "units")
            leaf = t.leaves(_unpacked(_packed(dense(units, n, weights))))
            met = rank[units]
            at = np.r_[0, np.cumsum(np.bincount(np.repeat(np.arange(len(n)), n)[met >= 0], minlength=len(n)))].astype(np.int32)
            usual = pa.ListArray.from_arrays(pa.array(at), pa.array(met[met >= 0].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf.astype(np.int32)), usual], names=[*b.schema.names, "leaf", "usual"])

    placed_rows = written(rows.mapInArrow(placed, "doc_id bigint, md5 string, terms array<int>, lengths array<int>, units array<int>, leaf int, usual array<int>"), "subject-leaves")
    leaf_of = placed_rows.where("leaf >= 0").select("doc_id", "md5", "leaf")
    genre = F.explode(F.array_distinct(F.filter(F.transform(F.split(F.lower(F.coalesce("genre", F.lit(""))), "[,;/]"), lambda g: F.element_at(F.create_map(*[F.lit(x) for kv in _GENRE.items() for x in kv]), F.trim(g))), lambda s: s.isNotNull())))
    by_genre = leaf_of.where("md5 is not null").select("md5", "leaf").distinct().join(catalog.select("md5", genre.alias("subject_code")), "md5").select("leaf", "subject_code", F.lit(1.0).alias("x"))
    by_hand = leaf_of.join(labels.select("doc_id", "subject_code"), "doc_id").select("leaf", "subject_code", F.lit(LABEL_WEIGHT).alias("x"))
    votes = by_genre.unionByName(by_hand).groupBy("leaf", "subject_code").agg(F.sum("x").alias("x")).toPandas()
    votes = votes[votes["subject_code"].isin(codes)]
    votes["s"] = votes["subject_code"].map({c: i for i, c in enumerate(codes)})
    table = _tables(votes, len(tree.left), "leaf", "s", len(codes)) if len(votes) else np.zeros((len(tree.left), len(codes)))
    usual = placed_rows.where("leaf >= 0").select("leaf", F.explode("usual").alias("term")).groupBy("leaf", "term").agg(F.count("*").alias("x")).toPandas()
    group = language_groups(_tables(usual, len(tree.left), "leaf", width=COMMON), np.flatnonzero(tree.left < 0))
    return placed_rows, pooled(placed_rows, named(table), group, codes)


def named(votes: np.ndarray) -> np.ndarray:
    """How much of each leaf is of each subject: its votes, smoothed and sharpened; zeros where none were given."""
    share = (votes + 0.02 * votes.sum(axis=0) / max(votes.sum(), 1)) / (votes.sum(axis=1, keepdims=True) + 0.02)
    share[~(votes.sum(axis=1) > 0)] = 0
    share = share**SHARPER
    return share / np.maximum(share.sum(axis=1, keepdims=True), 1e-12)


def pooled(rows: DataFrame, share: np.ndarray, group: np.ndarray, codes: list[str]) -> Model:
    """The discriminative terms of the leaves, pooled by language group and subject.

    ``rows`` have ``leaf, units, terms, lengths``. The first pass gives each leaf's terms to its subjects; the second
    reads sentences and lets the documents that are of one subject teach its terms inside their leaf's group.
    """
    sc = rows.sparkSession.sparkContext
    n_groups = int(group.max(initial=0)) + 1
    shared = sc.broadcast((share, group))  # leaves by subjects

    def leaf_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, at = shared.value
        total = np.zeros(n_groups * len(codes) * DIMS, dtype=np.float32)
        for b in batches:
            units, n = _lists(b, "units")
            leaf = np.repeat(b.column(b.schema.get_field_index("leaf")).to_numpy(zero_copy_only=False), n)
            units, leaf = units[leaf >= 0], leaf[leaf >= 0]
            for s in range(len(codes)):
                x = of[leaf, s]
                use = x > 1e-3
                np.add.at(total, (at[leaf[use]] * len(codes) + s) * DIMS + units[use], x[use].astype(np.float32))
        yield _emit(("s", "term"), total.reshape(-1, DIMS))

    def table(fn, columns: list[str]) -> np.ndarray:
        sums = _sums(rows.select(*columns), fn, "s int, term int, x double", ["s", "term"])
        return _tables(sums, n_groups * len(codes), "s").reshape(n_groups, len(codes), DIMS)

    model = Model(codes, _odds(table(leaf_terms, ["leaf", "units"])))
    now = sc.broadcast(model)

    def recount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, (_, at) = now.value, shared.value
        out = np.zeros(n_groups * len(codes) * DIMS, dtype=np.float32)
        for b in batches:
            terms, n_terms = _lists(b, "terms")
            lengths, n = _lists(b, "lengths")
            leaf = b.column(b.schema.get_field_index("leaf")).to_numpy(zero_copy_only=False)
            subject, _ = m.sentences(terms, lengths)
            ok = subject >= 0
            doc = np.repeat(np.arange(len(n)), n)
            held = np.bincount(doc[ok] * len(m.codes) + subject[ok], minlength=len(n) * len(m.codes)).reshape(len(n), -1)
            told = held.sum(axis=1)
            pure = (told >= 2) & (held.max(axis=1, initial=0) >= PURE * told) & (leaf >= 0)
            of = np.repeat(np.where(pure, at[np.maximum(leaf, 0)] * len(m.codes) + held.argmax(axis=1), -1), n_terms)
            np.add.at(out, of[of >= 0] * DIMS + terms[of >= 0], np.float32(1))
        yield _emit(("s", "term"), out.reshape(-1, DIMS))

    return Model(codes, _odds(table(recount, ["leaf", "terms", "lengths"])))


def language_groups(counts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Group number of each node: leaves that use the most common terms alike are of one language.

    ``counts`` holds how often each leaf has each of those terms.
    """
    v = np.sqrt(counts)
    v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    group = np.zeros(len(counts), dtype=np.int64)
    heads: list[int] = []
    for k in sorted(ends, key=lambda x: -counts[x].sum()):
        near = [(float(v[k] @ v[h]), -i) for i, h in enumerate(heads)]
        if near and max(near)[0] > 0.65:
            group[k] = -max(near)[1]
        else:
            group[k] = len(heads)
            heads.append(int(k))
    return group


def _odds(tables: np.ndarray) -> np.ndarray:
    """How much more each subject uses a term than its language does, as logarithm.

    ``tables`` holds counts by language group, subject and term. Subjects are weighed alike, a term used in several
    groups gets their mean, and a subject that a group lacks speaks for nothing in it.
    """
    total = tables.sum(axis=(0, 1))
    out = np.zeros(tables.shape[1:])
    for t in tables:
        size = t.sum(axis=1, keepdims=True)
        has = size[:, 0] > 0.002 * max(size.sum(), 1)
        if not has.any():
            continue
        p = t / np.maximum(size, 1e-9)
        mean = p[has].mean(axis=0, keepdims=True)
        floor = 2.0 / np.maximum(np.median(size[has]), 1.0)
        odds = np.clip(np.log((p + floor) / (mean + floor)), -3.0, 3.0)
        odds[~has] = -1.0 * (mean > 0)
        out += odds * (t.sum(axis=0) / np.maximum(total, 1e-9))
    return out


def mixtures(rows: DataFrame, model: Model) -> DataFrame:
    """``doc_id, subject_code, share``: the share of a document's sentences that each subject holds."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            terms, _ = _lists(b, "terms")
            lengths, n = _lists(b, "lengths")
            subject, _ = m.sentences(terms, lengths)
            doc = np.repeat(np.arange(len(n)), n)
            told = np.bincount(doc[subject >= 0], minlength=len(n))
            silent = told[doc] == 0  # all sentences of such a document are read as one
            if silent.any():
                whole = np.bincount(doc, weights=lengths, minlength=len(n)).astype(np.int64)
                best, margin = m.sentences(terms, whole)
                last = np.cumsum(n) - 1
                pick = (told == 0) & (n > 0) & (margin > 0) & (whole > 0)
                subject[last[pick]] = m.best[pick]
                told[pick] = 1
            ok = subject >= 0
            key, held = np.unique(doc[ok] * len(m.codes) + subject[ok], return_counts=True)
            d, s = key // len(m.codes), key % len(m.codes)
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(d)), pa.array([m.codes[x] for x in s], pa.string()), pa.array(held / np.maximum(told[d], 1)),
                pa.array(held.astype(np.int32)), pa.array(n[d].astype(np.int32)),
            ], names=["doc_id", "subject_code", "share", "held", "sentences"])

    return rows.select("doc_id", "terms", "lengths").mapInArrow(run, "doc_id bigint, subject_code string, share double, held int, sentences int")


def assign(documents: DataFrame, labels: DataFrame, catalog: DataFrame, subjects: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, subject_code, share, held, sentences`` for every subject met in a document, also in passing.

    Null and empty texts, and texts without a sentence of their own, give no row. Repeated documents give their rows
    each time. Without any label or readable genre nothing can be named and the result is empty. All items of
    ``item_text`` and all subjects are read; other columns are not.
    """
    codes = sorted(r.subject_code for r in subjects.select("subject_code").where("subject_code is not null").distinct().collect())
    rows = written(vectors(documents, items), "subject-vectors")
    placed, model = fit(rows, labels, catalog, codes)
    discard(rows)
    return mixtures(placed, model)


def enough() -> Column:
    """Whether a subject is more than met in passing: a fifth of all sentences, or the shares among the telling ones."""
    return (F.col("held") * ONE_OF >= F.col("sentences")) | (F.col("share") >= SHARE) & ((F.col("held") > 1) | (F.col("share") >= SINGLE))


def found(documents: DataFrame, labels: DataFrame, catalog: DataFrame, subjects: DataFrame, items: DataFrame) -> DataFrame:
    return assign(documents, labels, catalog, subjects, items).where(enough()).select("doc_id", "subject_code")
