"""Run a registered query in Spark and its oracle SQL in DuckDB, compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return [cols[i] for i in order], out


def digest(rows) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update(repr(r).encode())
    return h.hexdigest()[:16]


def compare(spark, con, name: str, sf_dir: str, fn, sql: str | None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["duck_rows"] = len(d_rows)
    sc, sr = canonical(s_cols, s_rows)
    dc, dr = canonical(d_cols, d_rows)
    ok = sc == dc and sr == dr
    res["status"] = "match" if ok else "MISMATCH"
    if not ok:
        res["spark_cols"] = sc
        res["duck_cols"] = dc
        only_s = [r for r in sr if r not in set(dr)][:3]
        only_d = [r for r in dr if r not in set(sr)][:3]
        res["only_spark"] = only_s
        res["only_duck"] = only_d
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    from playlens.session import build_session
    spark = build_session("local[8]")
    con = duckdb_connection(sf_dir)
    qs = entry.queries()
    sqls = entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, sf_dir, qs[name], sqls.get(name))
        except Exception as e:  # report and go on
            r = {"name": name, "status": "ERROR", "error": repr(e)[:2000]}
        if r["status"] not in ("match", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"done: {len(names or qs)} queries, {bad} not matching")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
