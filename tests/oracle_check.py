"""Run registered Spark queries and their DuckDB oracle side by side (as the driver does).

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Compares row count, column names and an order-insensitive hash of the values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def run(sf_dir, keys=None, spark=None, verbose=True):
    import __spark_entry__ as e
    from lakelens.session import build_session
    spark = spark or build_session(master="local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "4g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = e.queries(), e.oracle_sql()
    results = {}
    for key in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[key](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as exc:  # noqa: BLE001
            results[key] = ("spark_error", str(exc)[:400])
            if verbose:
                print(f"{key:28s} SPARK ERROR {str(exc)[:400]}")
            continue
        ts = time.time() - t0
        if key not in sqls:
            results[key] = ("rows_only", len(rows))
            if verbose:
                print(f"{key:28s} rows_only  rows={len(rows)} {ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[key])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as exc:  # noqa: BLE001
            results[key] = ("oracle_error", str(exc)[:400])
            if verbose:
                print(f"{key:28s} ORACLE ERROR {str(exc)[:400]}")
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(dcols, drows)
        ok = (len(rows) == len(drows)) and sorted(cols) == sorted(dcols) and h1 == h2
        results[key] = ("match" if ok else "MISMATCH", len(rows), len(drows))
        if verbose:
            print(f"{key:28s} {'match' if ok else 'MISMATCH'} rows={len(rows)}/{len(drows)} {ts:.1f}s")
            if not ok:
                if sorted(cols) != sorted(dcols):
                    print("   cols", sorted(cols), sorted(dcols))
                a, b = set(l1), set(l2)
                for x in sorted(a - b)[:3]:
                    print("   spark-only ", x[:300])
                for x in sorted(b - a)[:3]:
                    print("   oracle-only", x[:300])
    return results


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    run(sf, sys.argv[2:] or None)
