"""Run a registered Spark query and its DuckDB oracle on the same Parquet tables and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
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
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return v


def frame_key(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")]
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return False, f"columns {sorted(spark_pdf.columns)} != {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"rows {len(spark_pdf)} != {len(duck_pdf)}"
    a, b = frame_key(spark_pdf), frame_key(duck_pdf)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, first: {bad[0]}"
    return True, f"{len(a)} rows"


def run(sf_dir: str, names: list[str] | None = None, spark=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    from candela.session import get_spark

    spark = spark or get_spark("local[8]")
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sp = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            results[name] = (False, f"spark error: {str(e)[:400]}")
            print(name, results[name], flush=True)
            continue
        t1 = time.time()
        if name not in sqls:
            results[name] = (True, f"rows-only {len(sp)}")
        else:
            try:
                dk = con.execute(sqls[name]).df()
                results[name] = compare(sp, dk)
            except Exception as e:  # noqa: BLE001
                results[name] = (False, f"duckdb error: {str(e)[:400]}")
        print(f"{name:28s} {'OK ' if results[name][0] else 'BAD'} {results[name][1][:300]} "
              f"(spark {t1 - t0:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    run(sf, sys.argv[2:] or None)
