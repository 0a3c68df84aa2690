"""Run registered Spark queries and their DuckDB oracle side by side.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).to_pydatetime() if v.tzinfo else v.to_pydatetime()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(_norm(x) for x in rec))
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    return sorted(out, key=key)


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict[str, str]:
    from __spark_entry__ import oracle_sql, queries
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    result = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sp = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            result[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, result[name]) if verbose else None
            continue
        if name not in sqls:
            result[name] = f"no-oracle rows={len(sp)}"
            print(name, result[name]) if verbose else None
            continue
        try:
            dk = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            result[name] = f"DUCKDB ERROR {str(e)[:300]}"
            print(name, result[name]) if verbose else None
            continue
        if sorted(sp.columns) != sorted(dk.columns):
            result[name] = f"COLUMNS spark={sorted(sp.columns)} duck={sorted(dk.columns)}"
        elif len(sp) != len(dk):
            result[name] = f"ROWCOUNT spark={len(sp)} duck={len(dk)}"
        else:
            a, b = rows(sp), rows(dk)
            bad = [(x, y) for x, y in zip(a, b) if x != y]
            if bad:
                cols = sorted(sp.columns)
                x, y = bad[0]
                diff = [(c, u, v) for c, u, v in zip(cols, x, y) if u != v]
                result[name] = f"VALUES {len(bad)} rows differ; first: {diff[:4]}"
            else:
                result[name] = f"ok rows={len(sp)}"
        if verbose:
            print(f"{name}: {result[name]}  ({time.time() - t0:.1f}s)", flush=True)
    return result


if __name__ == "__main__":
    from dockstat.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if not (v.startswith("ok") or v.startswith("no-oracle"))}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
    sys.exit(1 if bad else 0)
