"""Run registered queries against their SQL on the same tables and compare values."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    if isinstance(v, list | tuple):
        return tuple(_norm(x) for x in v)
    return str(v) if hasattr(v, "isoformat") else v


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None):
    """(ok, message)"""
    start = time.time()
    df = fn(spark, sf_dir)
    rows = [r.asDict() for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return True, f"{len(rows)} rows, no SQL, {took:.1f}s"
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = [dict(zip(cols, r)) for r in cur.fetchall()]
    if sorted(df.columns) != sorted(cols):
        return False, f"columns {sorted(df.columns)} vs {sorted(cols)}"
    cols = sorted(cols)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    a = sorted((tuple(_norm(r[c]) for c in cols) for r in rows), key=key)
    b = sorted((tuple(_norm(r[c]) for c in cols) for r in want), key=key)
    if len(a) != len(b):
        return False, f"{len(a)} rows vs {len(b)}; e.g. {[x for x in a if x not in set(b)][:2]} / {[x for x in b if x not in set(a)][:2]}"
    if a != b:
        extra, missing = sorted(set(a) - set(b), key=key), sorted(set(b) - set(a), key=key)
        return False, f"{len(extra)} of {len(a)} differ, e.g.\n   {str(extra[:3])[:700]}\n   {str(missing[:3])[:700]}"
    return True, f"{len(a)} rows equal, {took:.1f}s"


def main(sf_dir: str, only: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    spark, con = make_session(), connect(sf_dir)
    sqls, failed = oracle_sql(), 0
    for name, fn in queries().items():
        if only and not any(o in name for o in only):
            continue
        try:
            ok, message = compare(spark, con, sf_dir, name, fn, sqls.get(name))
        except Exception as error:
            ok, message = False, str(error)[:700]
        failed += not ok
        print("ok  " if ok else "FAIL", name, message, flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
