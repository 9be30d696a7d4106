"""Run registered queries and their oracle SQL side by side (rows, columns, values).

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, sf_dir: str, key: str, query, sql: str, con) -> tuple[bool, str]:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} sql={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} sql={len(d_rows)}"
    a, b = canon(s_rows, s_cols), canon(d_rows, d_cols)
    diffs = [(x, y) for x, y in zip(a, b) if x != y]
    if diffs:
        return False, f"{len(diffs)} rows differ, e.g. {diffs[:3]}"
    return True, f"{len(s_rows)} rows, spark {t1 - t0:.1f}s"


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    from cinemetrics.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for key in keys or list(qs):
        if key not in sqls:
            df = qs[key](spark, sf_dir)
            print(f"{key:32s} ROWS-ONLY {df.count()} rows", flush=True)
            continue
        try:
            ok, msg = compare(spark, sf_dir, key, qs[key], sqls[key], con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{key:32s} {'OK ' if ok else 'BAD'} {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
