"""Spark-vs-DuckDB parity check for the registered queries.

Usage: python tests/parity.py [sf_dir] [name ...]

Compares column names, Arrow types, row counts and the multiset of rows
(exact, with a relative-tolerance fallback reported separately).
"""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def oracle_table(con, sql: str):
    rel = con.sql(sql) if hasattr(con, "sql") else con.execute(sql)
    for m in ("to_arrow_table", "fetch_arrow_table", "arrow"):
        if hasattr(rel, m):
            t = getattr(rel, m)()
            return t.read_all() if hasattr(t, "read_all") else t
    raise AttributeError("no arrow export on duckdb result")


def _norm(v):
    if isinstance(v, Decimal):
        return ("d", str(v.normalize()) if v == v else "nan")
    if isinstance(v, float):
        if math.isnan(v):
            return ("f", "nan")
        return ("f", v)
    return ("o", v)


def _key(row):
    return tuple((k[0], str(k[1])) for k in row)


def _close(a, b) -> bool:
    if a == b:
        return True
    if a[0] == "f" and b[0] == "f" and isinstance(a[1], float) and isinstance(b[1], float):
        return math.isclose(a[1], b[1], rel_tol=1e-9, abs_tol=1e-9)
    return False


def compare(spark_tbl, duck_tbl) -> dict:
    """Compare two pyarrow tables; returns a report dict."""
    s_cols = sorted(spark_tbl.column_names)
    d_cols = sorted(duck_tbl.column_names)
    rep = {"rows_spark": spark_tbl.num_rows, "rows_oracle": duck_tbl.num_rows,
           "cols_match": s_cols == d_cols}
    if not rep["cols_match"]:
        rep["cols_spark"], rep["cols_oracle"] = s_cols, d_cols
        rep["ok"] = False
        return rep
    s_types = {c: str(spark_tbl.schema.field(c).type) for c in s_cols}
    d_types = {c: str(duck_tbl.schema.field(c).type) for c in s_cols}
    diff_types = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    rep["type_diffs"] = diff_types
    s_rows = sorted((tuple(_norm(r[c]) for c in s_cols) for r in spark_tbl.select(s_cols).to_pylist()), key=_key)
    d_rows = sorted((tuple(_norm(r[c]) for c in s_cols) for r in duck_tbl.select(s_cols).to_pylist()), key=_key)
    exact = s_rows == d_rows
    close = exact or (len(s_rows) == len(d_rows)
                      and all(all(_close(a, b) for a, b in zip(x, y)) for x, y in zip(s_rows, d_rows)))
    rep["values_exact"] = exact
    rep["values_close"] = close
    if not close:
        bad = [(x, y) for x, y in zip(s_rows, d_rows) if x != y][:3]
        rep["first_diffs"] = [(dict(zip(s_cols, x)), dict(zip(s_cols, y))) for x, y in bad]
    rep["ok"] = rep["rows_spark"] == rep["rows_oracle"] and exact and not diff_types
    return rep


def run(sf_dir: str, names: list[str] | None = None, spark=None) -> dict:
    import __spark_entry__ as E
    from skyledger.session import build_session

    spark = spark or build_session("local[8]", shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        if name not in sqls:
            continue
        t0 = time.time()
        try:
            s_tbl = qs[name](spark, sf_dir).toArrow()
            d_tbl = oracle_table(con, sqls[name])
            rep = compare(s_tbl, d_tbl)
        except Exception as e:  # report and continue
            rep = {"ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        rep["sec"] = round(time.time() - t0, 2)
        out[name] = rep
        print(name, rep, flush=True)
    return out


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = run(sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if not v.get("ok")]
    print("FAILED:", bad)
    print(f"{len(res) - len(bad)}/{len(res)} ok")
