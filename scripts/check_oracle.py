"""Run registered Spark queries and their DuckDB oracle SQL side by side.

Usage: python scripts/check_oracle.py [sf_dir] [name ...]
Prints one line per query: rows, column match, exact / approximate value match.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v, approx):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2 ** 53:
            return repr(int(v))  # nullable integer columns arrive as float
        return f"{v:.9g}" if approx else repr(v)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return norm(v.item(), approx)
    return repr(v)


def rows(df: pd.DataFrame, approx: bool):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False):
        out.append(tuple(norm(x, approx) for x in rec))
    return sorted(out, key=repr)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from marketlens.session import get_session
    from marketlens.plans.registry import ORACLE, QUERIES
    spark = get_session()
    q, o = QUERIES, ORACLE
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"create view {t} as select * from read_parquet('{p}')")
    bad = 0
    for name in names or sorted(q):
        t0 = time.time()
        try:
            sdf = q[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK-ERROR {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in o:
            print(f"{name:32s} rows={len(sdf)} (no oracle) spark={ts:.1f}s")
            continue
        try:
            ddf = con.sql(o[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} DUCKDB-ERROR {str(e)[:300]}")
            bad += 1
            continue
        cols_ok = sorted(sdf.columns) == sorted(ddf.columns)
        exact = cols_ok and rows(sdf, False) == rows(ddf, False)
        approx = cols_ok and (exact or rows(sdf, True) == rows(ddf, True))
        status = "OK" if exact else ("APPROX" if approx else "MISMATCH")
        if not approx:
            bad += 1
        print(f"{name:32s} {status:8s} rows={len(sdf)}/{len(ddf)} cols={'ok' if cols_ok else 'DIFF'} spark={ts:.1f}s")
        if not cols_ok:
            print("   spark:", sorted(sdf.columns))
            print("   duck :", sorted(ddf.columns))
        elif not approx:
            a, b = rows(sdf, True), rows(ddf, True)
            sa, sb = set(a), set(b)
            print("   spark-only:", [r for r in a if r not in sb][:3])
            print("   duck-only :", [r for r in b if r not in sa][:3])
            print("   cols:", sorted(sdf.columns))
    print("FAILED" if bad else "ALL-PASS", bad)


if __name__ == "__main__":
    main()
