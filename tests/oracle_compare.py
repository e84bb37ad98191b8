"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [--sf 0.01] [name ...]

Compares column names, row counts and the multiset of rows (columns sorted
by name; doubles compared after rounding to 9 significant digits).
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{data_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def normalise(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, data_dir: str, con=None) -> tuple[bool, str]:
    from __spark_entry__ import oracle_sql, queries

    con = con or duck(data_dir)
    sdf = queries()[name](spark, data_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(oracle_sql()[name])
    d_cols = rel.columns
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duckdb={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row counts differ: spark={len(s_rows)} duckdb={len(d_rows)}"
    a, b = normalise(s_cols, s_rows), normalise(d_cols, d_rows)
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        return False, f"values differ ({len(s_rows)} rows): spark-only {only_s} duckdb-only {only_d}"
    return True, f"{len(s_rows)} rows"


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from __spark_entry__ import oracle_sql
    from tessera.session import get_session

    spark = get_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8",
                                                 "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    data_dir = f"/root/testdata/sf{args.sf}"
    con = duck(data_dir)
    names = args.names or sorted(oracle_sql())
    bad = 0
    for n in names:
        t = time.time()
        try:
            ok, msg = compare(spark, n, data_dir, con)
        except Exception as e:  # report and go on
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:32s} {time.time() - t:6.1f}s  {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
