"""Spark query vs DuckDB oracle: row count, column names and an
order-free value hash (doubles rounded to 6 places), like the driver."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from loomkit.plans.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, bool):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res = {"name": name, "spark_rows": len(srows), "duck_rows": len(drows),
           "cols_ok": sorted(scols) == sorted(dcols), "spark_sec": round(t1 - t0, 2)}
    hs, ls = digest(scols, srows)
    hd, ld = digest(dcols, drows)
    res["hash_ok"] = hs == hd
    res["ok"] = res["cols_ok"] and res["hash_ok"] and len(srows) == len(drows)
    if not res["ok"]:
        res["spark_cols"], res["duck_cols"] = scols, dcols
        diff_s = sorted(set(ls) - set(ld))[:3]
        diff_d = sorted(set(ld) - set(ls))[:3]
        res["only_spark"], res["only_duck"] = diff_s, diff_d
    return res


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from loomkit.session import get_spark
    sf_dir = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    names = argv or sorted(oracle_sql())
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    q, o = queries(), oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, q[n], o[n], sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": repr(e)[:600]}
        bad += not r["ok"]
        print(r, flush=True)
    missing = sorted(set(q) - set(o))
    print("rows-only (no oracle):", missing)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
