"""Runs registered queries in Spark and their SQL in DuckDB on the same files and compares the rows."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def session(cores: str = "8") -> SparkSession:
    return (SparkSession.builder.master(f"local[{cores}]").appName("ratemill-tests").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
            .config("spark.driver.memory", "12g").config("spark.sql.codegen.cache.maxEntries", "2000").config("spark.python.sql.dataFrameDebugging.enabled", "false").config("spark.sql.shuffle.partitions", "8")
            .config("spark.sql.session.timeZone", "UTC").getOrCreate())


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return v + 0.0
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: [(x is None, str(type(x)), x if x is not None else 0) for x in r])


def compare(spark, con, sf, fn, sql):
    df = fn(spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = rows_of(cols, cur.fetchall())
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(df.columns)} vs {sorted(cols)}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}; {got[:2]} vs {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    types = {(type(a).__name__, type(b).__name__) for g, w in zip(got, want) for a, b in zip(g, w) if a is not None and b is not None}
    odd = [t for t in types if t[0] != t[1]]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ ({sorted(df.columns)}): {bad[:2]}"
    if odd:
        return f"types differ: {odd}"
    if not got:
        return "no rows"
    return None


def main():
    from __spark_entry__ import oracle_sql, queries
    sf = sys.argv[1]
    names = sys.argv[2:]
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    sqls = oracle_sql()
    failed = 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            if name in sqls:
                msg = compare(spark, con, sf, fn, sqls[name])
            else:
                n = len(fn(spark, sf).collect())
                msg = None if n else "no rows"
        except Exception as e:
            msg = f"{type(e).__name__}: {str(e)[:700]}"
        failed += msg is not None
        print(f"{'ok  ' if msg is None else 'FAIL'} {name} {time.time() - t:.1f}s {msg or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
