"""Texts in containers of fixed capacity, by conflict-constrained best fit.

Items are spread over shards by a hash, about ``SHARD_CONTAINERS`` containers in each, and every shard packs its items
by itself, largest first. Open containers are ordered by the room left and carry bitmaps of the sources and duplicate
clusters in them; the search starts at the tightest container that an item fits in and goes on to its successors until
one without a conflict is found. The number of shards grows with the data, so no task does.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varak.sources.tables import written

CAPACITY = 8192
SHARD_CONTAINERS = 3000


def pack(sizes: list[int], clusters: list[int | None], sources: list[int | None], capacity: int = CAPACITY) -> list[int]:
    """The container number of each item, none larger than ``capacity``.

    Items of one cluster go to different containers, and so do those of one source unless that took a container more.
    Where a group has more items than there must be containers, each takes its even share of them, so that a hot group
    wastes no room.
    """
    least = max(1, -(-sum(sizes) // capacity))
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    hard, soft = ([0] * len(sizes) for _ in range(2))
    for groups, masks in ((clusters, hard), (sources, soft)):
        bit = 0
        counts = Counter(g for g in groups if g is not None and g == g)
        share = {g: -(-n // least) for g, n in counts.items() if n > 1}
        first: dict[int, int] = {}
        for g, a in share.items():
            first[g] = bit
            bit += a
        met: Counter = Counter()
        for i in order:
            g = groups[i]
            if g in share:
                masks[i] |= 1 << (first[g] + met[g] % share[g])
                met[g] += 1
    room: list[tuple[int, int]] = []
    copies: list[int] = []
    books: list[int] = []
    out = [0] * len(sizes)
    for i in order:
        size, of, book = sizes[i], hard[i], soft[i]
        k = at = bisect_left(room, (size, -1))
        while k < len(room) and (copies[room[k][1]] & of or books[room[k][1]] & book):
            k += 1
        if k == len(room) and book:  # rather the same source twice than a container more
            k = at
            while k < len(room) and copies[room[k][1]] & of:
                k += 1
        if k < len(room):
            left, b = room.pop(k)
        else:
            left, b = capacity, len(copies)
            copies.append(0)
            books.append(0)
        copies[b] |= of
        books[b] |= book
        out[i] = b
        if left > size:
            insort(room, (left - size, b))
    return out


def containers(df: DataFrame, key: str = "doc_id", column: str = "text", source: str = "md5", capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece_no, n_pieces, byte_start, tokens, container_id``: the container of each text or piece of it.

    A text has one token for each UTF-8 byte and an end token. Texts over the capacity are split into full pieces, each
    a container of its own, and a rest that is packed like any other item; shorter ones are never split. Null texts
    give no row, an empty text is one token, repeated rows are items of their own. Equal texts are one cluster.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.where(F.col(column).isNotNull()).select(
        F.col(key).alias("k"), (F.octet_length(column).cast("bigint") + 1).alias("n"), F.xxhash64(column).alias("cluster"),
        (F.when(F.col(source).isNotNull(), F.xxhash64(source)) if source in df.columns else F.lit(None).cast("bigint")).alias("source"),
    )
    rows = written(rows, "packing-sizes")  # sizes and hashes only, so that texts are read once
    total = rows.agg(F.sum(F.col("n") % capacity)).first()[0] or 0
    shards = max(1, -(-total // (capacity * SHARD_CONTAINERS)))
    rows = rows.withColumns({"rest": F.col("n") % capacity, "full": F.floor(F.col("n") / capacity), "shard": F.pmod(F.xxhash64("k", F.lit(7)), F.lit(shards))})
    pieces = rows.withColumn("n_pieces", (F.col("full") + (F.col("rest") > 0).cast("int")).cast("int"))
    whole = pieces.where("full > 0").select(
        "k", F.explode(F.sequence(F.lit(1), F.col("full").cast("int"))).alias("piece_no"), "n_pieces",
        F.lit(capacity).cast("bigint").alias("tokens"),
    )
    whole = whole.select("k", "piece_no", "n_pieces", ((F.col("piece_no") - 1) * F.lit(capacity).cast("bigint")).alias("byte_start"), "tokens", F.concat_ws("-", F.lit("full"), F.col("k").cast("string"), F.col("piece_no").cast("string")).alias("container_id"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rest", "k"], ascending=[False, True], kind="stable")
        groups = [[None if pd.isna(x) else int(x) for x in pdf[c]] for c in ("cluster", "source")]
        bins = pack(pdf["rest"].astype(int).tolist(), *groups, capacity)
        shard = pdf["shard"].iloc[0]
        return pd.DataFrame({
            "k": pdf["k"], "piece_no": (pdf["full"] + 1).astype("int32"), "n_pieces": pdf["n_pieces"],
            "byte_start": pdf["full"] * capacity, "tokens": pdf["rest"], "container_id": [f"{shard}-{b}" for b in bins],
        })

    schema = f"k {kind}, piece_no int, n_pieces int, byte_start bigint, tokens bigint, container_id string"
    rest = pieces.where("rest > 0").select("k", F.col("rest").cast("bigint"), F.col("full").cast("bigint"), "n_pieces", "cluster", "source", "shard").groupBy("shard").applyInPandas(run, schema)
    return whole.unionByName(rest).withColumnRenamed("k", key)


def found(df: DataFrame) -> DataFrame:
    """Documents that had to be split, once each: those whose pieces lie in more than one container."""
    pieces = containers(df).where("n_pieces > 1")
    return pieces.groupBy("doc_id").agg(F.count_distinct("container_id").alias("n")).where("n > 1").select("doc_id")
