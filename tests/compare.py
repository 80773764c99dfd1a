"""Compare registered queries with their SQL counterparts run by DuckDB.

    python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        # NaN equals NaN, and 0.0 equals -0.0.
        return ("nan" if math.isnan(v) else v + 0.0) if isinstance(v, float) else v

    return Counter(tuple(value(r[i]) for i in order) for r in rows)


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = dict(zip(names, (str(d[1]) for d in cur.description)))
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}"
    a, b = canonical(got, df.columns), canonical(want, names)
    if a != b:
        only_a, only_b = sorted(a - b, key=repr), sorted(b - a, key=repr)
        return f"{len(only_a)} rows differ, {sorted(names)}\n  spark {only_a[:2]}\n  sql   {only_b[:2]}\n  {types}"
    if any(type(p) is not type(q) for p, q in zip(max(a, key=repr, default=()), max(b, key=repr, default=()))):
        return "types differ"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()

    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{args.sf}"
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in queries:
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        started = time.time()
        try:
            if name in oracles:
                problem = difference(spark, con, queries[name], oracles[name], sf_dir)
            else:
                problem = None if queries[name](spark, sf_dir).count() else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        note = "" if name in oracles else " (no SQL)"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s{note}", flush=True)
        if problem:
            print("   ", problem, flush=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
