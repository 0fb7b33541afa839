"""Run registered queries and their SQL side by side and compare the rows.

    python -m tests.compare [--dir DIR] [name ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

TESTDATA = "/root/testdata"


def make_session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("flowspark")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    if hasattr(x, "isoformat"):
        return x.isoformat()
    return str(x)


def normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same rows and column names, else what differs."""
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want_rows = res.fetchall()
    got_rows = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got, want = normal(df.columns, got_rows), normal(names, want_rows)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    kinds = [
        (c, type(a), type(b))
        for c in df.columns
        for a, b in [(_first(df.columns, got_rows, c), _first(names, want_rows, c))]
        if a is not None and b is not None and type(a) is not type(b)
    ]
    if kinds:
        return f"types differ: {kinds}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(got)} rows differ, e.g. {wrong[0]}" if wrong else None


def _first(columns, rows, name):
    i = columns.index(name)
    return next((r[i] for r in rows if r[i] is not None), None)


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from flowspark.catalog import QUERIES, SQL

    args = argparse.ArgumentParser()
    args.add_argument("names", nargs="*")
    args.add_argument("--dir", default=f"{TESTDATA}/sf0.01")
    given = args.parse_args()
    spark, con = make_session(), oracle(given.dir)
    failed = 0
    for name in given.names or QUERIES:
        t = time.time()
        try:
            df = QUERIES[name](spark, given.dir)
            if name in SQL:
                problem = difference(df, con, SQL[name])
                rows = ""
            else:
                problem, rows = None, f" rows-only {len(df.collect())}"
        except Exception as e:
            problem, rows = f"{type(e).__name__}: {str(e)[:600]}", ""
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - t:.1f}s{rows} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main() > 0)
