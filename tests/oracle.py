"""Run registered queries on Spark and their SQL on DuckDB, and compare whole results.

    python tests/oracle.py [sf] [name prefix ...]
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else ("f", v + 0.0)
    if isinstance(v, bool) or v is None or isinstance(v, (int, str, bytes)):
        return v if not isinstance(v, bool) else ("b", v)
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return (type(v).__name__, v.isoformat())
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_plain(x) for x in v.tolist())
    return ("?", type(v).__name__, str(v))


def compare(df, con, sql: str) -> tuple[bool, str]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = [dict(zip(names, r)) for r in cur.fetchall()]
    cols = df.columns
    got = [r.asDict() for r in df.collect()]
    if sorted(cols) != sorted(names):
        return False, f"columns spark={sorted(cols)} sql={sorted(names)}"
    order = sorted(cols)
    key = lambda r: repr([_plain(r[c]) for c in order])
    a, b = sorted(map(key, got)), sorted(map(key, want))
    if a == b:
        return True, f"{len(a)} rows"
    extra = [x for x in a if x not in set(b)][:2]
    missing = [x for x in b if x not in set(a)][:2]
    return False, f"rows spark={len(a)} sql={len(b)}\n     spark {extra}\n     sql   {missing}"


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = tuple(sys.argv[2:])
    from sparkdesk.plans import load_all
    from sparkdesk.plans.registry import ORACLES, QUERIES
    from sparkdesk.session import get_session

    load_all()
    spark = get_session("oracle")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = duck(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in ORACLES:
                ok, note = compare(df, con, ORACLES[name])
            else:
                n = len(df.collect())
                ok, note = n > 0, f"{n} rows, no SQL"
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:900]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} {time.time() - t:6.2f}s  {note}", flush=True)
    print(f"failed: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
