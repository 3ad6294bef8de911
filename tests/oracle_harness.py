"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

Comparison is order-insensitive over rows, by column name: row count,
column names and every value must agree (floats to 9 significant digits,
timestamps as ISO text).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm_value(v):
    if v is None:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if float(v).is_integer() and abs(v) < 2**53:
            return int(v)
        return float(f"{v:.9g}")
    if hasattr(v, "item"):
        return _norm_value(v.item())
    return v


def normalize(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm_value(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    sc, dc = sorted(spark_pdf.columns), sorted(duck_pdf.columns)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"row count spark={len(spark_pdf)} duck={len(duck_pdf)}"
    a, b = normalize(spark_pdf), normalize(duck_pdf)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, e.g. {bad}"
    return True, f"{len(a)} rows"


def run(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict[str, tuple[bool, str]]:
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sp = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            out[name] = (False, f"spark error: {str(e)[:300]}")
            if verbose:
                print(f"{name}: SPARK ERROR {str(e)[:300]}", flush=True)
            continue
        t1 = time.time()
        if name not in sqls:
            out[name] = (True, f"rows-only {len(sp)} rows")
        else:
            try:
                du = con.execute(sqls[name]).df()
                out[name] = compare(sp, du)
            except Exception as e:  # noqa: BLE001
                out[name] = (False, f"duck error: {str(e)[:300]}")
        if verbose:
            print(f"{name}: {'OK ' if out[name][0] else 'BAD'} {out[name][1]}  spark {t1 - t0:.1f}s duck {time.time() - t1:.1f}s",
                  flush=True)
    return out


if __name__ == "__main__":
    from adsieve.session import local_session
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session(8)
    res = run(spark, sf, sys.argv[1:] or None)
    bad = [k for k, v in res.items() if not v[0]]
    print(f"\n{len(res) - len(bad)}/{len(res)} ok; bad: {bad}")
