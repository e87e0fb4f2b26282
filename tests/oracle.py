"""Compares a query's rows with its oracle's, as values and without order."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings doc_catalog doc_chunks listing author_names publisher_names eval_items subjects subject_labels".split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v: object) -> object:
    return round(v, 6) if isinstance(v, float) else v


def compare(spark, con, name: str, sf_dir: str) -> tuple[int, int, list, list]:
    """Row counts and some rows that only one side has."""
    df = entry.queries()[name](spark, sf_dir)
    names = sorted(df.columns)
    own = Counter(tuple(_plain(v) for v in r) for r in df.select(*names).collect())
    rel = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in rel.description]
    assert sorted(columns) == names, (sorted(columns), names)
    order = [columns.index(c) for c in names]
    theirs = Counter(tuple(_plain(r[i]) for i in order) for r in rel.fetchall())
    return sum(own.values()), sum(theirs.values()), list((own - theirs).items())[:2], list((theirs - own).items())[:2]


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    d = "/root/testdata/sf0.01"
    con = database(d)
    for name in sys.argv[1:] or entry.oracle_sql():
        began = time.time()
        try:
            a, b, x, y = compare(spark, con, name, d)
            print("ok  " if a and not x and not y else "DIFF", name, a, b, str(x)[:300], str(y)[:300], f"{time.time() - began:.1f}", flush=True)
        except Exception as e:
            print("FAIL", name, str(e)[:400].replace("\n", " "), flush=True)
    for name in [] if sys.argv[1:] else entry.queries():
        if name not in entry.oracle_sql() and not name.startswith("p"):
            try:
                print("rows", name, entry.queries()[name](spark, d).count(), flush=True)
            except Exception as e:
                print("FAIL", name, str(e)[:400].replace("\n", " "), flush=True)
