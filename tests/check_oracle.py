"""Runs registered queries against DuckDB: python tests/check_oracle.py [sf] [name ...]."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str):
    db = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{folder}/{t}.parquet"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return db


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(repr(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out)


def compare(spark, db, name, query, sql, folder):
    """None when equal, else a text; second value: seconds of the Spark side."""
    start = time.time()
    df = query(spark, folder)
    got = df.collect()
    seconds = time.time() - start
    if sql is None:
        return None, seconds, len(got)
    cur = db.execute(sql)
    want = cur.fetchall()
    names = [d[0] for d in cur.description]
    gc, gr = rows_of(df.columns, [tuple(r) for r in got])
    wc, wr = rows_of(names, want)
    if gc != wc:
        return f"columns {gc} / {wc}", seconds, len(got)
    if gr != wr:
        only_g = [r for r in gr if r not in set(wr)][:2]
        only_w = [r for r in wr if r not in set(gr)][:2]
        return f"rows {len(gr)} / {len(wr)}\n   spark {only_g}\n   sql   {only_w}", seconds, len(got)
    return None, seconds, len(got)


def main() -> int:
    from cardloom.session import build_session
    from cardloom.suite.catalog import ORACLES, QUERIES

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    folder = f"/root/testdata/sf{sf}"
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    bad = 0
    for name in names:
        try:
            problem, seconds, n = compare(spark, db, name, QUERIES[name], ORACLES.get(name), folder)
        except Exception as exc:  # report and go on
            problem, seconds, n = f"{type(exc).__name__}: {str(exc)[:1500]}", 0.0, 0
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {kind} {name:32s} {n:7d} rows {seconds:6.2f} s", flush=True)
        if problem:
            bad += 1
            print("   ", problem, flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
