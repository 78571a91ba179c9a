"""Run registered queries in Spark and their oracle SQL in DuckDB, and compare.

Usable from pytest (``compare``) and as a script:
    python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in BASE:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, int):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _rows_hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    normed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256()
    for r in normed:
        h.update(r.encode())
    return h.hexdigest(), normed


def compare(spark, key: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    t0 = time.time()
    sdf = queries()[key](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = list(sdf.columns)
    t1 = time.time()
    sql = oracle_sql().get(key)
    out = {"key": key, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "no_oracle"
        return out
    con = con or duck_connect(sf_dir)
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    out["duck_rows"] = len(drows)
    hs, ns = _rows_hash(scols, srows)
    hd, nd = _rows_hash(dcols, drows)
    out["cols_match"] = sorted(scols) == sorted(dcols)
    out["hash_match"] = hs == hd
    out["status"] = "ok" if (out["cols_match"] and hs == hd) else "MISMATCH"
    if out["status"] != "ok":
        out["spark_cols"] = sorted(scols)
        out["duck_cols"] = sorted(dcols)
        sset, dset = set(ns), set(nd)
        out["only_spark"] = sorted(sset - dset)[:3]
        out["only_duck"] = sorted(dset - sset)[:3]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from hrforge.session import get_session
    from __spark_entry__ import queries
    spark = get_session()
    con = duck_connect(sf_dir)
    keys = keys or list(queries())
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"key": k, "status": "ERROR", "error": repr(e)[:800]}
        if r["status"] not in ("ok", "no_oracle"):
            bad += 1
        print(r, flush=True)
    print(f"done: {len(keys)} keys, {bad} bad", flush=True)


if __name__ == "__main__":
    main(sys.argv)
