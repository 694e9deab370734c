"""Compare a registered Spark query with its DuckDB oracle statement:
row count, column names and an order-insensitive hash of the values.

Usable from pytest (``compare``) and from the command line:
    python tests/oracle_compare.py [sf_dir] [key,key,...]
"""

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
sys.path.insert(0, ROOT)

from tabsmith.sources.tables import DRIVER_TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
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
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=repr)
    return [cols[i] for i in order], out


def compare(spark, sf_dir: str, key: str, query_fn, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    df = query_fn(spark, sf_dir)
    s_cols, s_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    d_cols, d_rows = _rows([c[0] for c in res.description], res.fetchall())
    h = lambda rows: hashlib.sha256(repr(rows).encode()).hexdigest()[:16]
    out = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": s_cols == d_cols, "values_match": s_rows == d_rows,
           "spark_hash": h(s_rows), "oracle_hash": h(d_rows)}
    if not out["columns_match"]:
        out["spark_only"] = sorted(set(s_cols) - set(d_cols))
        out["oracle_only"] = sorted(set(d_cols) - set(s_cols))
    elif not out["values_match"]:
        ss, dd = set(s_rows), set(d_rows)
        out["spark_extra"] = [dict(zip(s_cols, r)) for r in list(ss - dd)[:2]]
        out["oracle_extra"] = [dict(zip(d_cols, r)) for r in list(dd - ss)[:2]]
    return out


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tabsmith.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2].split(",")) if len(sys.argv) > 2 else None
    # a long run of queries in one JVM: give the local driver a real heap
    spark = build_session("local[8]", 8, extra={"spark.driver.memory": "8g"})
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for k, fn in qs.items():
        if only and k not in only:
            continue
        if k not in sqls:
            print(f"{k:30s} (no oracle)")
            continue
        t0 = time.time()
        try:
            r = compare(spark, sf_dir, k, fn, sqls[k], con)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{k:30s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        ok = r["columns_match"] and r["values_match"]
        bad += not ok
        extra = "" if ok else {x: r[x] for x in r if x not in ("key",)}
        print(f"{k:30s} {'OK  ' if ok else 'FAIL'} rows={r['spark_rows']}/{r['oracle_rows']} "
              f"{time.time() - t0:5.1f}s {extra}", flush=True)
    print(f"failures: {bad}")


if __name__ == "__main__":
    main()
