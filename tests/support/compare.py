"""Compare registered queries with their SQL equivalents.

Run as a script: python -m tests.support.compare <folder> [query ...]
"""

from __future__ import annotations

import os
import sys
import tempfile
import time
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.plans.oracles import ORACLES
from tallyhouse.plans.queries import QUERIES
from tallyhouse.session import build_session


def local_session(**options: str) -> SparkSession:
    settings = {
        "spark__ui__enabled": "false",
        "spark__sql__shuffle__partitions": "8",
        "spark__driver__memory": "8g",
        "spark__sql__warehouse__dir": tempfile.mkdtemp(prefix="tallyhouse-warehouse-"),
        "spark__checkpoint__dir": tempfile.mkdtemp(prefix="tallyhouse-scratch-"),
        "spark__ui__showConsoleProgress": "false",
    }
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    spark = build_session("tallyhouse-tests", **{"spark__master": "local[8]"} | settings | options)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.sql(f"create view {path.stem} as select * from '{path}'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value) if isinstance(value, float) else str(value)


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both results hold the same columns and rows; else what differs."""
    expected = connection.sql(sql)
    if sorted(result.columns) != sorted(expected.columns):
        return f"columns {sorted(set(result.columns) ^ set(expected.columns))}"
    got = rows_of(result.columns, [tuple(row) for row in result.collect()])
    want = rows_of(expected.columns, expected.fetchall())
    if got == want:
        return None
    only_got = [row for row in got if row not in set(want)][:2]
    only_want = [row for row in want if row not in set(got)][:2]
    return f"{len(got)} rows, expected {len(want)}\n  got  {only_got}\n  want {only_want}\n  cols {sorted(result.columns)}"


def main(folder: str, *names: str) -> int:
    spark, connection, failed = local_session(), connect(folder), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            result = QUERIES[name](spark, folder)
            if name in ORACLES:
                problem = differences(result, connection, ORACLES[name])
            else:
                problem = None if result.count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name}" + (f": {problem}" if problem else ""), flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
