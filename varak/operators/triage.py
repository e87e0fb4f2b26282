"""What becomes of each attempt to extract a chunk, and what is tried next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varak import rules


def next_size(size: Column, sizes: tuple[int, ...] = rules.CHUNK_SIZES) -> Column:
    """The largest size below ``size``, null below the smallest."""
    return F.coalesce(*[F.when(size > s, F.lit(s)) for s in sizes])


def status(error: Column, code: Column, message: Column, size: Column, sizes: tuple[int, ...] = rules.CHUNK_SIZES) -> Column:
    """``status, size, key_expired`` of an attempt.

    ``error`` is null, ``server``, ``client``, ``validation``, ``parse`` or ``no_box``. Without error it is ok. Server
    errors and spent keys are tried again as they are; too much input, other client errors and invalid answers with the
    next smaller size, and where there is none the chunk is unprocessable; answers that can't be read are repairable.
    """
    spent = (error == "client") & F.coalesce(code == 429, F.lit(False)) & ~F.coalesce(message.contains(rules.INPUT_QUOTA), F.lit(False))
    smaller = next_size(size, sizes)
    row = lambda name, n: F.struct(F.lit(name).alias("status"), n.alias("size"), F.coalesce(spent, F.lit(False)).alias("key_expired"))
    return (
        F.when(error.isNull(), row("ok", size)).when((error == "server") | spent, row("retry", size)).when(error.isin("parse", "no_box"), row("repairable", size))
        .when(smaller.isNotNull(), row("retry", smaller)).otherwise(row("unprocessable", F.lit(None).cast("int")))
    )


def triaged(attempts: DataFrame) -> DataFrame:
    """``attempts`` (``error, code, message, size``) with ``status, key_expired`` and the size to go on with."""
    return attempts.withColumn("t", status(F.col("error"), F.col("code"), F.col("message"), F.col("size"))).withColumns({"size": F.col("t.size"), "status": F.col("t.status"), "key_expired": F.col("t.key_expired")}).drop("t")


def again(triaged_rows: DataFrame, totals: DataFrame) -> DataFrame:
    """Records to plan again, with the smallest size any of their retried chunks needs: ``md5, n_pages, size``."""
    sizes = triaged_rows.where("status = 'retry'").groupBy("md5").agg(F.min("size").alias("size"))
    return totals.join(sizes, "md5").select("md5", "n_pages", "size")


def usage(rows: DataFrame, key: str, order: str, tokens: str) -> DataFrame:
    """The last usage reported in each response's stream; pieces without one don't count."""
    return rows.where(F.col(tokens).isNotNull()).groupBy(key).agg(F.max_by(tokens, order).alias("tokens"))
