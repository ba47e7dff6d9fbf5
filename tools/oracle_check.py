"""Run every registered query and its DuckDB oracle; report mismatches.

Usage: python tools/oracle_check.py [sf_dir] [name ...]
"""
from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

import duckdb  # noqa: E402

from immolens.plans.catalog import ORACLE_SQL, QUERIES  # noqa: E402
from immolens.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def parquet_glob(sf_dir: str, table: str) -> str:
    """A table is one Parquet file or a folder of them."""
    path = os.path.realpath(f"{sf_dir}/{table}.parquet")
    return f"{path}/*.parquet" if os.path.isdir(path) else path


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def canon(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, name):
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    secs = time.time() - t0
    sql = ORACLE_SQL.get(name)
    if sql is None:
        return name, len(srows), None, "no-oracle", secs
    cur = con.execute(sql)
    onames = [d[0] for d in cur.description]
    orows = cur.fetchall()
    if sorted(onames) != sorted(sdf.columns):
        return name, len(srows), len(orows), f"columns {sorted(sdf.columns)} vs {sorted(onames)}", secs
    a, b = canon(srows, sdf.columns), canon(orows, onames)
    if a == b:
        return name, len(a), len(b), "ok", secs
    diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
    return name, len(a), len(b), f"DIFF {diff}", secs


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{parquet_glob(sf_dir, t)}')")
    bad = 0
    for n in names:
        try:
            res = compare(spark, con, sf_dir, n)
        except Exception as exc:  # report and go on
            res = (n, None, None, f"ERROR {type(exc).__name__}: {str(exc)[:300]}", 0)
        bad += res[3] != "ok"
        print(f"{res[0]:26s} spark={res[1]} oracle={res[2]} {res[4]:.2f}s {res[3]}", flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
