"""Catalogue predicates, selections and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varak import rules


def find(df: DataFrame, predicate: Column, limit: int | None = None, offset: int = 0, order: str = "md5") -> DataFrame:
    """Rows that meet a predicate; a limit or offset orders by ``order`` first."""
    out = df.where(predicate)
    if limit is not None or offset:
        out = out.orderBy(order).offset(offset)
        out = out.limit(limit) if limit is not None else out
    return out


def select_documents(df: DataFrame, md5: str | None = None, path: str | None = None, listing: DataFrame | None = None) -> DataFrame:
    """By content hash, or by path: a file or what lies below a directory, also by where the listing has it now."""
    if md5:
        return df.where(F.col("md5") == md5)
    if path and listing is not None:
        return df.join(listing.where(below(F.col("file_path"), path)).select("md5"), "md5", "left_semi")
    return df.where(below(F.col("ya_path"), path)) if path else df


def below(c: Column, path: str) -> Column:
    return (c == path) | c.startswith(path.rstrip("/") + "/")


def valid_md5(c: Column) -> Column:
    return F.lower(c).rlike("^[0-9a-f]{32}$")


def nontarget(language: Column) -> Column:
    """Labelled with other than one target language; null labels are not selected."""
    return ~language.isin(*rules.TARGET_LANGUAGES)


def nontarget_place(language: Column) -> Column:
    return F.concat(F.lit("nontatar/"), F.array_join(F.array_sort(F.split(language, ", ")), "-"))


def nontextual(mime: Column, path: Column, types: tuple = rules.NON_DOCUMENT_TYPES, suffixes: tuple = rules.NON_DOCUMENT_SUFFIXES) -> Column:
    return F.coalesce(mime.isin(*types), F.lit(False)) | F.coalesce(_ends(path, suffixes), F.lit(False))


def _ends(c: Column, suffixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for s in suffixes:
        out = out | c.endswith(s)
    return out


def skip_by_type(mime: Column, path: Column, types: tuple = rules.NON_DOCUMENT_TYPES, rescues: tuple = rules.RESCUES) -> Column:
    """``skip, mime_type``: whether a file is left out for its type, some being rescued by their extension."""
    out = F.when(~F.coalesce(mime.isin(*types), F.lit(False)), F.struct(F.lit(False).alias("skip"), mime.alias("mime_type")))
    for wrong, suffix, right in rescues:
        out = out.when((mime == wrong) & path.endswith(suffix), F.struct(F.lit(False).alias("skip"), F.lit(right).alias("mime_type")))
    return out.otherwise(F.struct(F.lit(True).alias("skip"), mime.alias("mime_type")))


def skip_by_path(path: Column, skips: tuple = rules.PATH_SKIPS) -> Column:
    """The fragment of the rule that leaves a path out, or null."""
    return F.coalesce(*[F.when((path.startswith(part) if whole else path.contains(part)) & _ends(path, ends), F.lit(part)) for part, whole, ends in skips])


def full(path: Column, mark: str = rules.LIMITED_MARK) -> Column:
    """Whether a file is complete, by where it lies."""
    return ~path.contains(mark)


def restricted(path: Column, mark: str = rules.HIDDEN_MARK) -> Column:
    return path.contains(mark)


def meta_slice(text: Column, chars: int = rules.META_CHARS) -> Column:
    """The beginning of a text from which metadata is drawn."""
    return F.substring(text, 1, chars)


def layout_pages(totals: DataFrame, most: int = rules.LAYOUT_PAGES) -> DataFrame:
    """``md5, page``: the pages whose layout is read, the first ``most`` from 0."""
    return totals.where("n_pages > 0").select("md5", F.explode(F.sequence(F.lit(0), F.least(F.col("n_pages"), F.lit(most)) - 1)).alias("page"))


def queue_sizes(df: DataFrame, skip: DataFrame) -> DataFrame:
    """One row with the length of each work queue."""
    named = {"nonpdf": nonpdf_queue(df), "pdf": pdf_queue(df, skip), "meta": meta_queue(df, skip), "upload": upload_queue(df), "layout": layout_queue(df)}
    rows = [q.select(F.lit(k).alias("queue")) for k, q in named.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.agg(*[F.count_if(F.col("queue") == k).alias(k) for k in named])


def nonpdf_queue(df: DataFrame) -> DataFrame:
    todo = df.where(F.col("content_url").isNull() & F.col("mime_type").isin(*rules.TEXT_TYPES))
    return todo.where((F.col("mime_type") != "text/csv") & ~F.col("ya_path").endswith(".csv"))


def pdf_queue(df: DataFrame, skip: DataFrame, language: str = "tt-Cyrl") -> DataFrame:
    todo = df.where(F.col("content_url").isNull() & (F.col("mime_type") == "application/pdf") & (F.col("language") == language) & F.col("is_full"))
    return todo.join(skip.select("md5"), "md5", "left_anti")


def meta_queue(df: DataFrame, skip: DataFrame) -> DataFrame:
    todo = df.where(F.col("meta").isNull() & (F.col("content_url").isNotNull() | (F.col("mime_type") == "application/pdf")))
    return todo.join(skip.select("md5"), "md5", "left_anti")


def upload_queue(df: DataFrame) -> DataFrame:
    return df.where(F.col("meta").isNull() | F.col("language").isin(*rules.SECOND_LANGUAGES))


def layout_queue(df: DataFrame, language: str = "tt-Cyrl") -> DataFrame:
    return df.where((F.col("mime_type") == "application/pdf") & (F.col("language") == language) & F.col("is_full"))


def meta_route(df: DataFrame) -> Column:
    return F.when(F.col("content_url").isNotNull(), "text").when(F.col("mime_type") == "application/pdf", "slice").otherwise("skip")


def library_candidates(df: DataFrame) -> DataFrame:
    """Candidates with the reason that leaves one out early, null where none does."""
    legal = F.lit(False)
    for a, b, suffix in rules.LEGAL_MARKS:
        legal = legal | (F.col("ya_path").contains(a) & F.col("ya_path").contains(b) & F.col("ya_path").endswith(suffix))
    rows = df.where(F.col("lib").isNull() & F.col("language").isin(*rules.TARGET_LANGUAGES) & F.col("content_url").isNotNull())
    reason = (
        F.when(~F.coalesce(F.col("is_full"), F.lit(False)), "not full").when(F.coalesce(F.col("sharing_restricted"), F.lit(False)), "sharing restricted")
        .when(F.coalesce(F.col("isbn"), F.lit("")) != "", F.lit(None)).when(F.coalesce(legal, F.lit(False)), "legal doc")
    )
    return rows.withColumn("reason", reason)


def unencrypted(df: DataFrame) -> DataFrame:
    """Restricted records with a plain link; null links pass."""
    return df.where(F.col("sharing_restricted") & (~F.col("ya_public_url").startswith("enc:") | ~F.col("document_url").startswith("enc:")))


def distribution(df: DataFrame, column: str, of: Column | None = None) -> DataFrame:
    """Rows per value, among those that meet ``of``, with their percentage of all rows."""
    total = df.agg(F.count("*").alias("total"))  # one row
    rows = (df.where(of) if of is not None else df).groupBy(column).agg(F.count("*").alias("n"))
    return rows.join(F.broadcast(total)).select(column, "n", F.round(F.col("n") * F.lit(100.0).cast("double") / F.col("total"), 2).alias("percent"))


def isbn_key(c: Column) -> Column:
    """The packed ISBN field as it is typed: trimmed values without empty ones, sorted, joined by ", "."""
    parts = F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(F.array_sort(parts), ", ")
