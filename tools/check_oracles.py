"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

usage: python tools/check_oracles.py [sf_dir] [name ...]
Prints one line per query: OK / MISMATCH / ERROR with row counts.
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from scorewright.plans.fixtures import BASE_TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ("~null",)
    if isinstance(v, float):
        return ("f", float(f"{v:.9g}"))
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("f", float(v))
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    try:
        if pd.isna(v):
            return ("~null",)
    except (TypeError, ValueError):
        pass
    return ("s", str(v))


def rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in pdf[cols].to_dict("records")]
    return cols, sorted(out, key=repr)


def compare(spark, con, name, sf_dir, fn, sql):
    t0 = time.time()
    s = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    if sql is None:
        return f"ROWS  {name}: spark={len(s)} ({t1 - t0:.1f}s)"
    d = con.sql(sql).df()
    sc, sr = rows(s)
    dc, dr = rows(d)
    if sc != dc:
        return f"MISMATCH {name}: columns spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return f"MISMATCH {name}: rows spark={len(sr)} duck={len(dr)}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    if bad:
        return f"MISMATCH {name}: {len(bad)} rows differ; first spark={bad[0][0]} duck={bad[0][1]}"
    return f"OK    {name}: rows={len(sr)} ({t1 - t0:.1f}s)"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:]
    from scorewright.session import get_session
    from scorewright.plans.registry import QUERIES, ORACLES, load_all
    load_all()
    spark = get_session("local[8]")
    con = duck(sf_dir)
    for name in names or sorted(QUERIES):
        try:
            print(compare(spark, con, name, sf_dir, QUERIES[name], ORACLES.get(name)), flush=True)
        except Exception as exc:  # noqa: BLE001
            msg = str(exc).split("\n")[0][:400]
            print(f"ERROR {name}: {type(exc).__name__}: {msg}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()


if __name__ == "__main__":
    main()
