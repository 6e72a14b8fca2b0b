"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Same rule as the driver: columns sorted by name, row count, column names,
and the multiset of row values. Usage::

    python tests/oracle_compare.py [sf_dir] [name ...]
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
sys.path.insert(0, ROOT)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, (dt.date, bool, int, str)):
        return str(v)
    return str(v)


def compare(spark, sf_dir: str, name: str, qfn, sql: str | None, con) -> dict:
    t0 = time.time()
    df = qfn(spark, sf_dir)
    cols = sorted(df.columns)
    srows = [tuple(norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    t_spark = time.time() - t0
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows_raw = cur.fetchall()
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    dsorted = [dcols[i] for i in order]
    drows = [tuple(norm(r[i]) for i in order) for r in drows_raw]
    res["oracle_rows"] = len(drows)
    if dsorted != cols:
        res["status"] = f"SCHEMA spark={cols} oracle={dsorted}"
        return res
    if len(drows) != len(srows):
        res["status"] = "ROWCOUNT"
        return res
    a, b = sorted(srows), sorted(drows)
    if a != b:
        for x, y in zip(a, b):
            if x != y:
                diff = {c: (p, q) for c, p, q in zip(cols, x, y) if p != q}
                res["status"] = f"VALUES first diff {diff}"
                break
        return res
    res["status"] = "OK"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from starmart.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in names or list(qs):
        try:
            r = compare(spark, sf_dir, n, qs[n], sqls.get(n), con)
        except Exception as e:  # report and go on
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("OK", "rows-only")
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
