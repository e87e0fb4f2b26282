"""Reconciliation of a file listing with the catalogue; what is to be done as rows, never as side effects."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varak import rules
from varak.operators.catalog import full, isbn_key, nontarget, nontarget_place, nontextual, skip_by_path, skip_by_type


def duplicate_groups(catalog: DataFrame) -> DataFrame:
    """Groups of two or more records with the same ISBN field: ``isbn_key, n_documents``."""
    keyed = catalog.where("isbn is not null").select(isbn_key(F.col("isbn")).alias("isbn_key"), "md5")
    return keyed.where("isbn_key <> ''").groupBy("isbn_key").agg(F.count("*").alias("n_documents")).where("n_documents > 1")


def isbn_survivors(catalog: DataFrame) -> DataFrame:
    """``isbn_key, md5, rule, keep`` for each record of a duplicate group.

    The only full record stays, else the only full PDF, else the only extracted full PDF, else, where all records agree
    in type, completeness and pages, the first by public URL; other groups need a review and ``keep`` is null.
    All counts come from one aggregation with partial sums, so a hot group is never gathered.
    """
    whole, pdf = F.coalesce(F.col("is_full"), F.lit(False)), F.coalesce(F.col("mime_type").isin(*rules.PDF_TYPES), F.lit(False))
    extracted = F.coalesce(F.col("content_url") != "", F.lit(False))
    rows = catalog.where("isbn is not null").select(
        isbn_key(F.col("isbn")).alias("isbn_key"), "md5", whole.alias("a"), (whole & pdf).alias("b"), (whole & pdf & extracted).alias("c"),
        F.concat_ws("-", F.coalesce(F.col("page_count").cast("string"), F.lit("?")), F.coalesce("mime_type", F.lit("?")), whole.cast("string")).alias("shape"), "ya_public_url",
    ).where("isbn_key <> ''")
    counts = rows.groupBy("isbn_key").agg(
        F.count("*").alias("n"), F.count_if("a").alias("na"), F.count_if("b").alias("nb"), F.count_if("c").alias("nc"),
        F.min("shape").alias("lo"), F.max("shape").alias("hi"), F.min_by("md5", F.struct(F.coalesce("ya_public_url", F.lit("")), "md5")).alias("first"),
    ).where("n > 1")
    rule = F.when(F.col("na") == 1, "one_full").when(F.col("nb") == 1, "one_full_pdf").when(F.col("nc") == 1, "one_extracted_pdf").when(F.col("lo") == F.col("hi"), "all_alike").otherwise("needs_review")
    joined = rows.join(counts, "isbn_key").withColumn("rule", rule)
    keep = F.when(F.col("rule") == "one_full", F.col("a")).when(F.col("rule") == "one_full_pdf", F.col("b")).when(F.col("rule") == "one_extracted_pdf", F.col("c")).when(F.col("rule") == "all_alike", F.col("md5") == F.col("first"))
    return joined.select("isbn_key", "md5", "rule", keep.alias("keep"))


def wiping_plan(catalog: DataFrame, stored: DataFrame | None = None, incomplete: DataFrame | None = None) -> DataFrame:
    """``md5, destination``; a duplicate beats a non-document, that a foreign language, that the stored plan.

    ``incomplete`` has the ``md5`` of files that are also there in full; the stored plan deletes them (``void``).
    """
    parts = [
        catalog.where(nontarget(F.col("language"))).select("md5", nontarget_place(F.col("language")).alias("destination"), F.lit(1).alias("rank")),
        catalog.where(nontextual(F.col("mime_type"), F.col("ya_path"))).select("md5", F.lit("nontextual").alias("destination"), F.lit(2).alias("rank")),
        isbn_survivors(catalog).where("not keep").select("md5", F.concat(F.lit("duplicated_isbn/"), "isbn_key").alias("destination"), F.lit(3).alias("rank")),
    ]
    if stored is not None:
        parts.append(stored.select("md5", "destination", F.lit(0).alias("rank")))
    if incomplete is not None:
        parts.append(incomplete.select("md5", F.lit("void").alias("destination"), F.lit(0.5).cast("double").alias("rank")))
    plan = parts[0]
    for p in parts[1:]:
        plan = plan.unionByName(p)
    return plan.groupBy("md5").agg(F.max_by("destination", "rank").alias("destination"))


def listing_actions(listing: DataFrame, catalog: DataFrame, plan: DataFrame) -> DataFrame:
    """``md5, path, resource_id, action`` for each file of the listing.

    Of several entries with one hash the first by time and path is the file; others with another resource are removed.
    Directories and entries without hash give no row.
    """
    path = F.regexp_replace("file_path", "^disk:", "")
    files = listing.where("entry_type = 'file' and md5 is not null").withColumn("path", path).dropDuplicates(["md5", "path", "resource_id"])
    first = files.groupBy("md5").agg(F.min_by("resource_id", F.struct(F.coalesce("listed_at", F.lit("9999-01-01").cast("timestamp_ntz")), "path", F.coalesce("resource_id", F.lit("")))).alias("first_id"))
    known = catalog.select("md5", F.col("ya_resource_id").alias("known_id"), F.col("ya_path").alias("known_path"), F.lit(True).alias("known"))
    rows = files.join(first, "md5").join(known, "md5", "left").join(plan.select("md5", "destination"), "md5", "left")
    main = F.when(F.col("known"), F.col("known_id")).otherwise(F.col("first_id"))
    action = (
        F.when(F.col("destination").isNotNull(), F.concat(F.lit("move:"), "destination")).when(skip_by_path(F.col("path")).isNotNull(), "skip")
        .when(skip_by_type(F.col("mime_type"), F.col("path"))["skip"], "nontextual").when(~F.coalesce(F.col("resource_id") == main, F.lit(False)), "remove_duplicate")
        .when(F.coalesce(F.col("known_path") == F.col("path"), F.lit(False)), "unchanged").otherwise("upsert")
    )
    return rows.select("md5", "path", "resource_id", action.alias("action"))


def move_target(path, destination, root: str = "/corpus"):
    """Where a file goes: null to be deleted, else below ``filtered_out`` with its path from the root."""
    rest = F.regexp_replace(path, f"^{root}/", "")
    return F.when(destination != "void", F.concat(F.lit(f"{root}/filtered_out/"), destination, F.lit("/"), rest))


def delete_batches(keys: DataFrame, plan: DataFrame, size: int = 1000) -> DataFrame:
    """Object keys that begin with a planned hash, numbered in full batches of ``size``: ``obj_key, batch``.

    A hash has 32 characters, so the prefix join is an equality. Keys are numbered inside 4,096 buckets of the hash, and
    the buckets' counts, one row each, give where each begins: no sort gathers all keys in one task.
    """
    hit = keys.withColumn("md5", F.substring("obj_key", 1, 32)).join(plan.select("md5").distinct(), "md5", "left_semi").withColumn("bucket", F.substring("md5", 1, 3))
    counts = hit.groupBy("bucket").agg(F.count("*").alias("n"))
    before = counts.select("bucket", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    numbered = hit.withColumn("k", F.row_number().over(Window.partitionBy("bucket").orderBy("obj_key"))).join(F.broadcast(before), "bucket")  # 4,096 rows
    return numbered.select("obj_key", F.floor((F.col("before") + F.col("k") - 1) / size).cast("bigint").alias("batch"))


def with_upstream(files: DataFrame, upstream: DataFrame) -> DataFrame:
    """Files of a listing with the link of the metadata supplied for them, null where there is none."""
    one = upstream.groupBy("md5").agg(F.max("url").alias("upstream_meta_url"))
    return files.join(one, "md5", "left")


def merged(first: DataFrame, second: DataFrame, key: str = "md5") -> DataFrame:
    """Rows of two corpora, each key once; where both have it the second wins, then the smaller row."""
    rows = first.withColumn("rank", F.lit(1)).unionByName(second.withColumn("rank", F.lit(0)))
    rest = [c for c in first.columns if c != key]
    one = rows.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct("rank", *rest)).alias("r"))
    return one.select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def display_order(rows: DataFrame, group: str, order: str, key: str = "md5") -> DataFrame:
    """Rows of each group numbered from 1 as they are shown: by ``order``, nulls first, ties by key."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(F.coalesce(order, F.lit("")), key)))


def restricted_audit(catalog: DataFrame, listing: DataFrame) -> DataFrame:
    """Restricted in the catalogue but not on disk, and the other way round: ``md5, problem``."""
    in_db = catalog.where("sharing_restricted").select("md5")
    on_disk = listing.where(F.col("file_path").contains(rules.HIDDEN_MARK) & F.col("md5").isNotNull()).select("md5").distinct()
    return in_db.join(on_disk, "md5", "left_anti").withColumn("problem", F.lit("missing_on_disk")).unionByName(on_disk.join(in_db, "md5", "left_anti").withColumn("problem", F.lit("not_restricted_in_catalog")))


def name_key(c):
    """The canonical notation of a file name; Spark has no built-in for it."""

    def nfc(s: pd.Series) -> pd.Series:
        return s.map(lambda x: unicodedata.normalize("NFC", x.strip()), na_action="ignore")

    plain = c.rlike(r"\A[\x21-\x7E](?:[\x20-\x7E]*[\x21-\x7E])?\z")  # already canonical
    return F.when(plain, c).otherwise(F.pandas_udf(nfc, "string")(F.when(~plain, c)))


def limited_matches(listing: DataFrame) -> DataFrame:
    """Incomplete files that are also there in full, by name: ``name, md5, full_md5``; of equal names the last listed counts."""
    rows = listing.where("entry_type = 'file' and md5 is not null and file_name is not null").select(name_key(F.col("file_name")).alias("name"), "md5", full(F.col("file_path")).alias("full"), "listed_at")
    last = F.struct(F.coalesce("listed_at", F.lit("0001-01-01").cast("timestamp_ntz")), "md5")
    of = lambda which: F.max(F.when(which, last))["md5"]
    one = rows.groupBy("name").agg(of(~F.col("full")).alias("md5"), of(F.col("full")).alias("full_md5"))
    return one.where("md5 is not null and full_md5 is not null and md5 <> full_md5")


def migrations(matches: DataFrame, upstream: DataFrame) -> DataFrame:
    """What moves supplied metadata from an incomplete file to the full one: ``op, source, target``."""
    rows = matches.join(upstream.select("md5", "url"), "md5", "left")
    copy = rows.where("url is not null").select(F.lit("copy").alias("op"), F.concat("md5", F.lit(".zip")).alias("source"), F.concat("full_md5", F.lit(".zip")).alias("target"))
    return copy.unionByName(rows.select(F.lit("delete").alias("op"), F.concat("md5", F.lit(".zip")).alias("source"), F.lit(None).cast("string").alias("target")))


def upsert(old: DataFrame, new: DataFrame, key: str = "md5") -> DataFrame:
    """A new snapshot: rows of ``new`` replace those of ``old``, whose other columns stay where ``new`` has null."""
    o, n = old.alias("o"), new.alias("n")
    columns = [F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) if c in new.columns else F.col(f"o.{c}").alias(c) for c in old.columns]
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(*columns)


def delete(df: DataFrame, plan: DataFrame, key: str = "md5") -> DataFrame:
    return df.join(plan.select(key), key, "left_anti")


def link_actions(catalog: DataFrame, probes: DataFrame) -> DataFrame:
    """What restores a dead public link: keep it, publish again at the same path, or upload the stored copy."""
    rows = catalog.select("md5", "ya_public_url").join(probes.select("md5", "url_ok", "path_ok"), "md5", "left")
    action = F.when(F.coalesce("url_ok", F.lit(False)), "keep").when(F.coalesce("path_ok", F.lit(False)), "republish").otherwise("upload")
    return rows.select("md5", action.alias("action"))
