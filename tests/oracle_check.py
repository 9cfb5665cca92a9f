"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

``python tests/oracle_check.py [folder] [name ...]``
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entries  # noqa: E402
from tradewind.session import local_session  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if hasattr(value, "as_tuple"):
        return repr(float(value))
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, folder):
    """None when equal, otherwise a short description; also the number of rows."""
    df = entries.queries()[name](spark, folder)
    got_columns, got = table(df.columns, [tuple(r) for r in df.collect()])
    sql = entries.oracle_sql().get(name)
    if sql is None:
        return None, len(got), False
    cur = con.execute(sql)
    want_columns, want = table([d[0] for d in cur.description], cur.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} / {want_columns}", len(got), True
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}", len(got), True
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{len(bad)} rows differ, first {bad[0]}", len(got), True
    return None, len(got), True


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = local_session(8), connect(folder)
    failures = 0
    for name in entries.queries():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            problem, rows, checked = compare(spark, con, name, folder)
        except Exception as error:  # report and go on
            problem, rows, checked = f"{type(error).__name__}: {str(error)[:1500]}", -1, True
        failures += problem is not None
        mark = "FAIL" if problem else ("ok" if checked else "rows only")
        print(f"{mark:9} {name:45} {rows:7} rows {time.time() - start:6.2f} s {problem or ''}", flush=True)
    print("failures:", failures)


if __name__ == "__main__":
    main()
