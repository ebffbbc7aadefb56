"""Run every registered query and its SQL oracle side by side and report.

    python tools/check_queries.py [table_dir] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripflow.plans import catalog, oracle  # noqa: E402
from tripflow.session import build_session  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sortable(row: tuple) -> tuple:
    return tuple((value is not None, str(type(value).__name__), value if value is not None else 0) for value in row)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=_sortable)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    frame = catalog.queries()[name](spark, sf_dir)
    started = time.time()
    got = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    took = time.time() - started
    result = con.execute(oracle.oracle_sql()[name])
    columns = [item[0] for item in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if got != want:
        differing = [(a, b) for a, b in zip(got, want) if a != b][:3]
        return False, f"rows {len(got)} vs {len(want)}; first differences {differing}"
    return True, f"{len(got)} rows, {took:.2f} s"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(catalog.queries())
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        try:
            good, note = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            good, note = False, f"{type(error).__name__}: {str(error)[:400]}"
        failed += not good
        print("ok  " if good else "FAIL", name, note, flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
