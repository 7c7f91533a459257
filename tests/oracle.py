"""Comparison of registered queries with their SQL twins in DuckDB.

``python tests/oracle.py [sf dir] [query ...]`` checks them one by one.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 6) + 0.0
    if hasattr(value, "as_tuple"):
        return float(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"first difference:\n   spark  {str(g)[:600]}\n   duckdb {str(w)[:600]}"
    return None


def main() -> int:
    from feedmill.plans import catalog
    from feedmill.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(catalog.QUERIES)
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            if name in catalog.ORACLES:
                problem = compare(spark, con, name, catalog.QUERIES[name], catalog.ORACLES[name], sf_dir)
                verdict = problem or "ok"
            else:
                problem = None
                verdict = f"{catalog.QUERIES[name](spark, sf_dir).count()} rows, no SQL twin"
        except Exception as exc:  # noqa: BLE001
            problem = verdict = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} good")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
