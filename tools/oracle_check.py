"""Run registered queries on Spark and their oracle SQL on DuckDB; compare results.

usage: python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, Decimal):
        return round(float(v), 6) + 0.0
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    from costwise.plans import all_queries
    qs = all_queries()
    con = duck(sf_dir)
    results = {}
    for name, q in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = q.build(spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK_ERROR", str(e)[:2000])
            if verbose:
                print(f"{name:32s} SPARK_ERROR {str(e)[:1500]}", flush=True)
            continue
        t1 = time.time()
        if q.sql is None:
            results[name] = ("NO_ORACLE", len(srows))
            if verbose:
                print(f"{name:32s} rows={len(srows)} (no oracle) spark={t1-t0:.1f}s", flush=True)
            continue
        try:
            rel = con.sql(q.sql)
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("DUCK_ERROR", str(e)[:2000])
            if verbose:
                print(f"{name:32s} DUCK_ERROR {str(e)[:1500]}", flush=True)
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        ok = ok_cols and a == b
        results[name] = ("OK" if ok else "MISMATCH", len(srows), len(drows))
        if verbose:
            msg = f"{name:32s} {'OK' if ok else 'MISMATCH'} spark_rows={len(srows)} duck_rows={len(drows)} spark={t1-t0:.1f}s"
            if not ok_cols:
                msg += f"\n   cols spark={sorted(scols)}\n   cols duck ={sorted(dcols)}"
            elif not ok:
                sa, sb = set(a), set(b)
                only_s = [r for r in a if r not in sb][:3]
                only_d = [r for r in b if r not in sa][:3]
                msg += f"\n   cols={sorted(scols)}\n   only spark: {only_s}\n   only duck : {only_d}"
            print(msg, flush=True)
    return results


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = set(sys.argv[2:]) or None
    from costwise.session import local_session
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "NO_ORACLE")}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok; bad: {sorted(bad)}")
