"""Runs registered queries next to their SQL twins in DuckDB and compares every value.

    python tools/compare.py [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd

from mercata.catalog import ORACLES, QUERIES
from mercata.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    """One spelling per value, exact for floats."""
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if hasattr(value, "isoformat"):
        text = pd.Timestamp(value).isoformat()
        return text
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return repr(value + 0.0)
    return f"{type(value).__name__}:{value}"


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


SPARK_KIND = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def compare(spark, con, folder: str, name: str) -> tuple[str, str, float, int]:
    started = time.time()
    df = QUERIES[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if name not in ORACLES:
        return ("rows" if got else "EMPTY"), "", took, len(got)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return "COLUMNS", f"{sorted(set(columns) ^ set(df.columns))}", took, len(got)
    odd = {c: (k, kinds[c]) for c, k in df.dtypes if SPARK_KIND.get(k) != kinds[c]}
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if len(a) != len(b):
        return "ROWS", f"{len(a)} against {len(b)}", took, len(got)
    if a != b:
        left = [x for x in a if x not in set(b)][:2] if len(a) < 200000 else []
        right = [x for x in b if x not in set(a)][:2] if len(b) < 200000 else []
        return "VALUES", f"{sorted(columns)}\n   spark {left}\n   sql   {right}", took, len(got)
    return ("ok" if not odd else "TYPES"), str(odd or ""), took, len(got)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session()
    con = database(args.sf)
    bad = 0
    for name in args.names or list(QUERIES):
        try:
            state, note, took, n = compare(spark, con, args.sf, name)
        except Exception as error:  # noqa: BLE001
            state, note, took, n = "ERROR", "".join(traceback.format_exception_only(error))[:700], 0.0, 0
        bad += state not in ("ok", "rows")
        print(f"{state:8} {name:32} {n:8d} rows {took:6.2f}s {note}", flush=True)
    print(f"{bad} of {len(args.names or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main()))
