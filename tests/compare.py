"""Run registered queries on Spark and their check SQL on DuckDB, and compare."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TESTDATA = os.environ.get("STRATAWARD_TESTDATA", "/root/testdata")


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return f"DECIMAL {v}"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return f"{type(v).__name__}:{v}"


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(norm(r[i]) for i in order) for r in rows])


def compare(spark, con, name, fn, sql, sf_dir):
    """Returns (rows, problem or None, seconds)."""
    start = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return len(got), None, took
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    want = rel.fetchall()
    if sorted(df.columns) != sorted(cols):
        return len(got), f"columns {sorted(df.columns)} != {sorted(cols)}", took
    a, b = table(df.columns, got), table(cols, want)
    if len(a) != len(b):
        return len(got), f"rows {len(a)} != {len(b)}", took
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return len(got), f"{len(bad)} rows differ, first {sorted(df.columns)}:\n   spark {bad[0][0]}\n   duck  {bad[0][1]}", took
    return len(got), None, took


def main():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from strataward.plans.queries import all_oracles, all_queries
    from strataward.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    only = sys.argv[2:]
    sf_dir = f"{TESTDATA}/sf{sf}"
    spark = build_session(
        master="local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracles, failed = all_oracles(), 0
    for name, fn in all_queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        try:
            rows, problem, took = compare(spark, con, name, fn, oracles.get(name), sf_dir)
        except Exception as e:
            rows, problem, took = -1, f"{type(e).__name__}: {str(e)[:1500]}", 0
        failed += problem is not None
        mark = "FAIL" if problem else ("ok  " if name in oracles else "rows")
        print(f"{mark} {name:34s} {rows:7d} rows {took:6.2f}s {problem or ''}{' EMPTY' if rows == 0 else ''}", flush=True)
    print("failed", failed)


if __name__ == "__main__":
    main()
