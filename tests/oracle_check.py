"""Run registered queries against their DuckDB oracle SQL.

Usable from tests and by hand:

    python tests/oracle_check.py --sf /root/testdata/sf0.01 [name ...]

Rows are compared as multisets after sorting columns by name, the way the
round driver compares them.
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tablesift.sources.tables import ALL_TABLES  # noqa: E402


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in ALL_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return names, out


def compare(spark, name, build, sql, sf_dir, con=None):
    con = con or duck_connection(sf_dir)
    t0 = time.time()
    df = build(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    t2 = time.time()
    sn, sv = canonical(df.columns, srows)
    dn, dv = canonical(dcols, drows)
    ok = sn == dn and sv == dv
    detail = ""
    if not ok:
        if sn != dn:
            detail = f"columns spark={sn} duck={dn}"
        else:
            ss, ds = set(sv), set(dv)
            detail = (
                f"rows spark={len(sv)} duck={len(dv)}; only spark {sorted(ss - ds, key=repr)[:5]}; "
                f"only duck {sorted(ds - ss, key=repr)[:5]}"
            )
    return ok, len(srows), t1 - t0, t2 - t1, detail


def main():
    from __spark_entry__ import oracle_sql, queries
    from tablesift.session import build_session

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--plain", action="store_true", help="bare session without the library defaults")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    if args.plain:
        from pyspark.sql import SparkSession

        spark = (
            SparkSession.builder.master("local[8]")
            .config("spark.ui.enabled", "false")
            .config("spark.sql.session.timeZone", "America/Los_Angeles")
            .getOrCreate()
        )
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session("local[8]")
    qs, sqls = queries(), oracle_sql()
    con = duck_connection(args.sf)
    bad = 0
    for name in args.names or list(qs):
        if name not in sqls:
            df = qs[name](spark, args.sf)
            t0 = time.time()
            n = df.count()
            print(f"{name:24s} rows-only  rows={n} spark={time.time() - t0:.2f}s", flush=True)
            continue
        ok, n, ts, td, detail = compare(spark, name, qs[name], sqls[name], args.sf, con)
        bad += not ok
        print(f"{name:24s} {'OK  ' if ok else 'FAIL'} rows={n} spark={ts:.2f}s duck={td:.2f}s {detail}", flush=True)
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
