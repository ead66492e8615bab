"""Run registered Spark queries next to their DuckDB oracle and compare.

Usage: python tests/oracle_compare.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
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
        return ("dec", str(v.normalize()))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = [tuple(norm(r[c]) for c in cols) for r in sdf.collect()]
    ts = time.time() - t0
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), sec=round(ts, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows_raw = res.fetchall()
    if sorted(dcols) != cols:
        return dict(name=name, ok=False, why=f"columns spark={cols} duck={sorted(dcols)}")
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(norm(r[i]) for i in idx) for r in drows_raw]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    a, b = sorted(srows, key=key), sorted(drows, key=key)
    ok = a == b
    out = dict(name=name, ok=ok, rows=len(a), duck_rows=len(b), sec=round(ts, 2))
    if not ok:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["why"] = f"first diffs {diff}" if diff else "row count"
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from velocast.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = dict(name=name, ok=False, why=f"{type(e).__name__}: {str(e)[:400]}")
        bad += r.get("ok") is False
        print("\nRESULT", r, flush=True)
    print(f"{len(qs)} queries, {len(sqls)} with oracle, {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
