"""Run a registered query in Spark and its oracle in DuckDB; compare.

Usage: ``python tests/oracle_compare.py [sf_dir] [key ...]``. Prints one
line per key and exits non-zero on any mismatch. Comparison: same column
names, same row count, same multiset of rows (column order by name, floats
rounded to 4 places; ``ORACLE_EXACT=1`` compares floats bit for bit).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0 if EXACT else round(v, 4) + 0.0
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(cols: list[str], rows) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, key: str, sf_dir: str, con=None) -> tuple[bool, str]:
    import __spark_entry__ as entry

    df = entry.queries()[key](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(key)
    if sql is None:
        return True, f"{key}: rows={len(s_rows)} (no oracle)"
    con = con or duck(sf_dir)
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"{key}: columns differ spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"{key}: rows differ spark={len(s_rows)} duck={len(d_rows)}"
    a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
    if a != b:
        diff = list((a - b).items())[:3], list((b - a).items())[:3]
        return False, f"{key}: values differ spark-only={diff[0]} duck-only={diff[1]}"
    return True, f"{key}: ok rows={len(s_rows)}"


def main(argv: list[str]) -> int:
    from precinct.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as entry

    keys = argv[2:] or list(entry.queries())
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            ok, msg = compare(spark, k, sf_dir, con)
        except Exception as exc:  # report and go on
            ok, msg = False, f"{k}: ERROR {type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
