"""Spark-vs-DuckDB comparison for registered queries.

Run as a script for a report:  python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits=9):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) + 0.0
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item(), digits)
        except Exception:
            pass
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return v
    return v


def _rows(cols, records, digits):
    return sorted((tuple(_norm(r[c], digits) for c in cols) for r in records), key=repr)


def compare(spark_df, con, sql: str | None, digits: int = 9) -> dict:
    t0 = time.time()
    srows = [r.asDict() for r in spark_df.collect()]
    scols = spark_df.columns
    t1 = time.time()
    out = {"spark_rows": len(srows), "spark_sec": round(t1 - t0, 3)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    dcols = rel.columns
    drecs = [dict(zip(dcols, r)) for r in rel.fetchall()]
    out["duck_rows"] = len(drecs)
    if sorted(scols) != sorted(dcols):
        out["status"] = f"COLUMNS differ: spark={sorted(scols)} duck={sorted(dcols)}"
        return out
    cols = sorted(scols)
    a, b = _rows(cols, srows, digits), _rows(cols, drecs, digits)
    if len(a) != len(b):
        out["status"] = "ROWCOUNT differ"
        return out
    diffs = [(x, y) for x, y in zip(a, b) if x != y]
    if diffs:
        out["status"] = f"VALUES differ in {len(diffs)} rows; first: spark={diffs[0][0]} duck={diffs[0][1]}"
        out["cols"] = cols
    else:
        out["status"] = "ok"
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from civicflow.session import build_session
    import __spark_entry__ as E
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        try:
            res = compare(fn(spark, sf_dir), con, sqls.get(name))
        except Exception as exc:  # report and go on
            res = {"status": f"ERROR {type(exc).__name__}: {str(exc)[:400]}"}
        ok = res["status"] in ("ok", "rows-only")
        bad += not ok
        print(f"{'PASS' if ok else 'FAIL'} {name}: {res}", flush=True)
    print(f"failed: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
