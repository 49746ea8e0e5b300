"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

    python tests/oracle_harness.py [sf_dir] [name ...]

Comparison: column names, row count, and the multiset of rows (columns in
name order; values compared exactly, floats also within 1e-9 relative to tell
formatting from arithmetic).
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, exact: bool):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if exact else float(f"{v:.9g}")
    return v


def _rows(cols: list[str], rows, exact: bool) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i], exact) for i in order) for r in rows)


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    out["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"COLUMNS spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return out
    if _rows(s_cols, s_rows, True) == _rows(d_cols, d_rows, True):
        out["status"] = "ok"
    elif _rows(s_cols, s_rows, False) == _rows(d_cols, d_rows, False):
        out["status"] = "ok~ (floats differ in last bits)"
    else:
        a, b = _rows(s_cols, s_rows, False), _rows(d_cols, d_rows, False)
        only_s, only_d = list((a - b).elements())[:3], list((b - a).elements())[:3]
        out["status"] = f"MISMATCH spark-only={only_s} oracle-only={only_d}"
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tillroll.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        bad += not str(r["status"]).startswith(("ok", "rows-only"))
        print(r, flush=True)
    print(f"{bad} failing of {len(names) or len(qs)}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
