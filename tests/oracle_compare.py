"""Spark-vs-DuckDB comparison of registered queries (used by tests and by hand).

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


STRICT = os.environ.get("ORACLE_STRICT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return v + 0.0 if STRICT else round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), x if x is not None else 0) for x in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols, tol=1e-6):
    """Returns (ok, exact, message).  Columns are matched by name."""
    if sorted(spark_cols) != sorted(duck_cols):
        return False, False, f"columns differ: {sorted(spark_cols)} vs {sorted(duck_cols)}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=_key)
    if len(a) != len(b):
        return False, False, f"row count {len(a)} vs {len(b)}"
    exact = a == b
    for ra, rb in zip(a, b):
        for c, x, y in zip(order, ra, rb):
            if isinstance(x, float) and isinstance(y, (float, int)):
                if not math.isclose(x, y, rel_tol=tol, abs_tol=tol):
                    return False, exact, f"{c}: {x} vs {y} in {ra}"
            elif x != y:
                return False, exact, f"{c}: {x!r} vs {y!r} in {ra}"
    return True, exact, f"{len(a)} rows"


def run(spark, sf_dir: str, names=None):
    import __spark_entry__ as entry
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # report and go on with the next query
            results[name] = (False, False, f"spark error: {str(e)[:300]}", time.time() - t0)
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = (None, None, f"{len(rows)} rows (no oracle)", ts)
            continue
        try:
            rel = con.sql(sqls[name])
            ok, exact, msg = compare(rows, df.columns, rel.fetchall(), rel.columns)
        except Exception as e:
            ok, exact, msg = False, False, f"duckdb error: {str(e)[:300]}"
        results[name] = (ok, exact, msg, ts)
    return results


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    if os.environ.get("ORACLE_PLAIN_SESSION") == "1":
        # a session as a caller might build it: none of the library's settings
        from pyspark.sql import SparkSession
        b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
        if os.environ.get("ORACLE_TZ"):
            b = b.config("spark.sql.session.timeZone", os.environ["ORACLE_TZ"])
        spark = b.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from cloudmarts.session import build_session
        spark = build_session("local[8]", shuffle_partitions=8)
    res = run(spark, sf, sys.argv[2:] or None)
    for k, (ok, exact, msg, ts) in res.items():
        tag = "NOSQL" if ok is None else ("PASS " if ok else "FAIL ")
        print(f"{tag} exact={exact!s:5} {ts:6.2f}s {k}: {msg}")
