"""Run a registered Spark job and its DuckDB oracle side by side and compare
row count, column names and an order-insensitive value multiset.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return cols, out


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    sc, sv = canon(scols, srows)
    dc, dv = canon(dcols, drows)
    ok = sc == dc and len(sv) == len(dv) and sv == dv
    info = {"name": name, "ok": ok, "spark_rows": len(sv), "oracle_rows": len(dv),
            "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2)}
    if not ok:
        info["spark_cols"], info["oracle_cols"] = sc, dc
        sset, dset = set(sv), set(dv)
        info["only_spark"] = [r for r in sv if r not in dset][:3]
        info["only_oracle"] = [r for r in dv if r not in sset][:3]
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    if os.environ.get("PLAIN_SESSION"):
        # the driver's kind of session: nothing of ours configured up front
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from sightline.session import build_session
        spark = build_session("local[8]", 8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        if name not in sqls:
            sdf = qs[name](spark, sf_dir)
            print({"name": name, "rows_only": sdf.count()})
            continue
        try:
            info = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as exc:  # report and continue
            info = {"name": name, "ok": False, "error": str(exc)[:800]}
        bad += not info["ok"]
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
