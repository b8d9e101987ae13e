"""Runs registered queries against their SQL; prints one line per query.

Usage: python tests/check_oracle.py [folder of tables] [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as spark_entry  # noqa: E402
from playtide.session import local_session  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def value_key(value) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def compare(spark_rows, spark_columns, oracle_rows, oracle_columns) -> str:
    """Empty when both sides have the same columns and the same rows in any order."""
    if sorted(spark_columns) != sorted(oracle_columns):
        return f"columns {sorted(spark_columns)} != {sorted(oracle_columns)}"
    order = sorted(spark_columns)

    def canonical(rows, columns):
        at = [columns.index(c) for c in order]
        return sorted(tuple(value_key(row[i]) for i in at) for row in rows)

    left, right = canonical(spark_rows, spark_columns), canonical(oracle_rows, oracle_columns)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{order}: {a} != {b}"
    return ""


def check(spark, con, folder: str, name: str) -> tuple[str, int, float]:
    start = time.time()
    found = spark_entry.queries()[name](spark, folder)
    rows = [tuple(r) for r in found.collect()]
    seconds = time.time() - start
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        return "rows only", len(rows), seconds
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    problem = compare(rows, found.columns, cursor.fetchall(), columns)
    return problem or "ok", len(rows), seconds


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(spark_entry.queries())
    spark, con, bad = local_session(), connect(folder), []
    for name in names:
        try:
            result, rows, seconds = check(spark, con, folder, name)
        except Exception as error:  # keep going, report at the end
            traceback.print_exc(limit=3)
            result, rows, seconds = f"FAILED {type(error).__name__}: {str(error)[:600]}", -1, 0.0
        if result not in ("ok", "rows only"):
            bad.append(name)
        print(f"{name:28s} {seconds:7.2f}s {rows:7d} rows  {result[:900]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
