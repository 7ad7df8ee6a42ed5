"""Run registered analytics in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/compare.py [sf_dir] [name ...]

Comparison: same column names, same row count, and the same multiset of
rows after normalising values (floats rounded to 9 significant digits,
dates/timestamps as ISO text).  This mirrors the driver's order-insensitive
value check.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
                 "smallint": "SMALLINT", "float": "FLOAT"}


def type_diffs(sdf, rel):
    """Columns whose Spark type does not map to the DuckDB type."""
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for c, t in sdf.dtypes:
        want = SPARK_TO_DUCK.get(t, t.upper())
        if d_types.get(c) != want:
            out.append((c, t, d_types.get(c)))
    return out


def rows_key(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows), key=lambda r: repr(r))


def compare(spark, sf_dir: str, names=None, verbose=True):
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in (names or list(qs)):
        t0 = time.time()
        sdf = qs[name](spark, sf_dir)
        s_cols = sdf.columns
        s_rows = [tuple(r) for r in sdf.collect()]
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("rows-only", len(s_rows))
            if verbose:
                print(f"{name:45s} rows-only  spark={len(s_rows)} ({ts:.1f}s)")
            continue
        rel = con.sql(sqls[name])
        d_cols = list(rel.columns)
        d_rows = rel.fetchall()
        # align duckdb columns to spark's order by name
        ok_cols = sorted(s_cols) == sorted(d_cols)
        if ok_cols:
            idx = [d_cols.index(c) for c in s_cols]
            d_rows = [tuple(r[i] for i in idx) for r in d_rows]
        ok = ok_cols and len(s_rows) == len(d_rows) and rows_key(s_rows) == rows_key(d_rows)
        tdiff = type_diffs(sdf, rel) if ok_cols else []
        results[name] = ("ok" if ok else "MISMATCH", len(s_rows), len(d_rows), tdiff)
        if verbose and tdiff:
            print(f"   type differences in {name}: {tdiff}")
        if verbose:
            print(f"{name:45s} {'ok' if ok else 'MISMATCH':8s} spark={len(s_rows)} "
                  f"duck={len(d_rows)} ({ts:.1f}s)")
            if not ok:
                if not ok_cols:
                    print("   cols spark", s_cols, "duck", d_cols)
                else:
                    a, b = rows_key(s_rows), rows_key(d_rows)
                    sa, sb = set(a), set(b)
                    print("   spark-only", sorted(sa - sb, key=repr)[:5])
                    print("   duck-only ", sorted(sb - sa, key=repr)[:5])
    return results


if __name__ == "__main__":
    from tally.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, names)
    bad = [n for n, r in res.items() if r[0] == "MISMATCH"]
    print(f"{len(res) - len(bad)}/{len(res)} ok; mismatches: {bad}")
    sys.exit(1 if bad else 0)
