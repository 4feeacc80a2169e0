"""Compare every registered query with its DuckDB oracle (as the driver does).

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v  # exact: no rounding
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None) -> dict[str, dict]:
    import __spark_entry__ as e
    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or qs:
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = _rows(s_cols, [tuple(r) for r in df.collect()])
        res = {"rows": len(s_rows)}
        if name in sqls:
            rel = con.sql(sqls[name])
            d_cols = rel.columns
            d_rows = _rows(d_cols, rel.fetchall())
            res.update(oracle_rows=len(d_rows),
                       columns_match=sorted(s_cols) == sorted(d_cols),
                       values_match=Counter(s_rows) == Counter(d_rows))
            res["ok"] = res["columns_match"] and res["values_match"]
            if not res["columns_match"]:
                res["spark_columns"], res["oracle_columns"] = s_cols, d_cols
        else:
            res["ok"] = None
        out[name] = res
    return out


if __name__ == "__main__":
    from starload.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    result = compare(spark, sf, sys.argv[2:] or None)
    for k, v in result.items():
        print(k, v)
    bad = [k for k, v in result.items() if v["ok"] is False]
    print("FAILED:", bad if bad else "none")
