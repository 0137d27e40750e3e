"""Compare registered queries with their SQL on one data folder.

    python tests/check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when both tables hold the same rows, else a description."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    g, w = canonical(got), canonical(want)
    for c in g.columns:
        a, b = g[c].astype(object), w[c].astype(object)
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            return f"column {c}: {int((~same).sum())} of {len(g)} differ, e.g. {a[~same].iloc[0]!r} != {b[~same].iloc[0]!r}"
        # pandas has no plain integers with nulls: Spark sends them as floats
        nullable = g[c].dtype.kind == "f" and g[c].isna().any() and w[c].dtype.kind == "i"
        if g[c].dtype.kind != w[c].dtype.kind and not nullable:
            return f"column {c}: type {g[c].dtype} != {w[c].dtype}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = duck(sf_dir), entry.oracle_sql()
    for name, fn in entry.queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            got = fn(spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in sql:
                print(f"ROWS {name} {len(got)} rows {took:.1f}s", flush=True)
                if len(got) < 40:
                    print(got.to_string(), flush=True)
                continue
            t1 = time.time()
            bad = difference(got, con.execute(sql[name]).df())
            print(f"{'FAIL' if bad else 'ok  '} {name} {len(got)} rows {took:.1f}s sql {time.time() - t1:.1f}s {bad or ''}", flush=True)
        except Exception as e:  # report and go on with the next query
            print(f"FAIL {name}: {type(e).__name__} {str(e)[:600]}", flush=True)


if __name__ == "__main__":
    main()
