"""Compare registered Spark queries with their DuckDB oracles.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, schema match, exact value match.
"""
from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v, digits):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) + 0.0
    if hasattr(v, "isoformat"):
        return str(v)[:10] if len(str(v)) >= 10 and " 00:00:00" in str(v) else str(v)
    return v


def frame_rows(df: pd.DataFrame, digits: int):
    cols = sorted(df.columns)
    rows = []
    for rec in df[cols].itertuples(index=False, name=None):
        rows.append(tuple(_norm(v, digits) for v in rec))
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(sdf: pd.DataFrame, odf: pd.DataFrame, digits: int = 6):
    sc, sr = frame_rows(sdf, digits)
    oc, orr = frame_rows(odf, digits)
    if sc != oc:
        return False, f"columns differ: spark-only={set(sc) - set(oc)} oracle-only={set(oc) - set(sc)}"
    if len(sr) != len(orr):
        return False, f"rows {len(sr)} vs {len(orr)}"
    bad = [(a, b) for a, b in zip(sr, orr) if a != b]
    if bad:
        a, b = bad[0]
        diffs = [(c, x, y) for c, x, y in zip(sc, a, b) if x != y]
        return False, f"{len(bad)} rows differ; first: {diffs[:6]}"
    return True, "ok"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from tallyrisk.session import get_session
    import __spark_entry__ as E
    spark = get_session()
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or sorted(qs)):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK-ERROR {str(e)[:400]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in oracle:
            print(f"{name:32s} rows={len(sdf)} (no oracle) {t1 - t0:.1f}s")
            continue
        try:
            odf = con.execute(oracle[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} ORACLE-ERROR {str(e)[:400]}")
            bad += 1
            continue
        ok, msg = compare(sdf, odf)
        exact, _ = compare(sdf, odf, 12)
        bad += not ok
        print(f"{name:32s} rows={len(sdf)}/{len(odf)} {'OK' if ok else 'FAIL'} exact12={exact} {msg if not ok else ''} "
              f"{t1 - t0:.1f}s")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
