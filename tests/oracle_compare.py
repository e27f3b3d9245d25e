"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python -m tests.oracle_compare [sf_dir] [key ...]

Comparison: same column names, same row count, and the same multiset of
rows (columns sorted by name, floats compared exactly, timestamps naive).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return 0.0 if v == 0 else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    problems = []
    if sorted(spark_cols) != sorted(duck_cols):
        problems.append(f"columns differ: spark={spark_cols} duck={duck_cols}")
        return problems
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=_key)
    if len(a) != len(b):
        problems.append(f"row count spark={len(a)} duck={len(b)}")
    diffs = [(x, y) for x, y in zip(a, b) if x != y]
    if diffs:
        problems.append(f"{len(diffs)} differing rows, e.g. cols={order}\n  spark={diffs[0][0]}\n  duck ={diffs[0][1]}")
    return problems


def run(sf_dir: str, keys=None, spark=None, verbose=True):
    import importlib
    sys.path.insert(0, ".")
    entry = importlib.import_module("__spark_entry__")
    if spark is None:
        from tidemark.session import get_session
        spark = get_session("local[8]", shuffle_partitions=8)
    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
            if k not in oracle:
                results[k] = ("rows-only", len(srows), [])
            else:
                rel = con.sql(oracle[k])
                dcols = rel.columns
                drows = rel.fetchall()
                results[k] = ("checked", len(srows), compare(srows, scols, drows, dcols))
        except Exception as e:  # noqa: BLE001
            results[k] = ("error", 0, [f"{type(e).__name__}: {str(e)[:800]}"])
        if verbose:
            kind, n, probs = results[k]
            status = "OK" if not probs else "FAIL"
            print(f"{status:4} {k:34} {kind:9} rows={n:<8} {time.time() - t0:6.2f}s")
            for p in probs:
                print("     ", p)
    return results


if __name__ == "__main__":
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    res = run(sf, args[1:] or None)
    bad = [k for k, v in res.items() if v[2]]
    print(f"{len(res) - len(bad)}/{len(res)} ok", "FAILED: " + ", ".join(bad) if bad else "")
    sys.exit(1 if bad else 0)
