"""Run registered queries on Spark and their SQL oracle on DuckDB over the same parquet tables and
compare row count, column names and an order-insensitive hash of the values.

    python tests/oracle_harness.py [sf_dir] [query ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == int(v) and abs(v) < 2**53:
            return int(v)
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return {"query": name, "rows": len(srows), "oracle": None, "sec": round(t1 - t0, 2)}
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    sh, sl = _digest(scols, srows)
    dh, dl = _digest(dcols, drows)
    res = {
        "query": name,
        "rows": (len(srows), len(drows)),
        "cols_match": sorted(scols) == sorted(dcols),
        "hash_match": sh == dh,
        "sec": round(t1 - t0, 2),
    }
    if not (res["cols_match"] and res["hash_match"]):
        res["cols"] = (sorted(scols), sorted(dcols))
        only_s = sorted(set(sl) - set(dl))[:3]
        only_d = sorted(set(dl) - set(sl))[:3]
        res["only_spark"], res["only_oracle"] = only_s, only_d
    return res


def main(argv):
    from wharf.session import local_session
    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        r = compare(spark, con, name, fn, orc.get(name), sf_dir)
        ok = r.get("oracle", 1) is None or (r["cols_match"] and r["hash_match"] and r["rows"][0] == r["rows"][1])
        bad += not ok
        print(("OK  " if ok else "FAIL"), r, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
