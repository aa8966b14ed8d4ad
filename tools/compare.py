"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

usage: python tools/compare.py [sf_dir] [--strict] [name-prefix ...]
(--strict compares floats exactly instead of at 6 decimals)
"""
from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from plumbline.plans.catalog import load_all  # noqa: E402
from plumbline.plans.standins import TABLES  # noqa: E402
from plumbline.session import get_session  # noqa: E402


STRICT = "--strict" in sys.argv


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return (v + 0.0) if STRICT else round(v, 6) + 0.0
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    args = [a for a in sys.argv[1:] if a != "--strict"]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    prefixes = [a for a in args if not a.startswith("/")]
    reg = load_all()
    spark = get_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    ok = bad = 0
    for name, (fn, sql) in reg.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if sql is None:
            print(f"ROWS {name}: {len(srows)} rows ({ts:.1f}s)")
            continue
        try:
            res = con.execute(sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {name}: columns spark={sorted(scols)} duck={sorted(dcols)}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a == b:
            ok += 1
            print(f"OK   {name}: {len(a)} rows ({ts:.1f}s)")
        else:
            bad += 1
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            print(f"FAIL {name}: rows spark={len(a)} duck={len(b)} first diffs={diff}")
    print(f"ok={ok} bad={bad}")
    spark.stop()


if __name__ == "__main__":
    main()
