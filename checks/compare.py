"""Runs registered queries beside their SQL and compares columns, types and values.

    python -m checks.compare [--data FOLDER] [name ...]
"""

import argparse
import math
import os
import signal
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _cell(value) -> tuple:
    if value is None or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if hasattr(value, "item"):
        value = value.item()
    return (1, repr(value))


def _rows(table, names) -> list[tuple]:
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(tuple(_cell(x) for x in row) for row in zip(*columns, strict=True))


def differences(spark_frame: DataFrame, connection, sql: str) -> list[str]:
    """Empty when both sides agree exactly."""
    left = spark_frame.toArrow()
    right = connection.execute(sql).to_arrow_table()
    found = []
    names = sorted(left.column_names)
    if names != sorted(right.column_names):
        return [f"columns {names} <> {sorted(right.column_names)}"]
    for n in names:
        a, b = str(left.schema.field(n).type), str(right.schema.field(n).type)
        if a.replace("large_", "") != b.replace("large_", ""):
            found.append(f"type of {n}: {a} <> {b}")
    if left.num_rows != right.num_rows:
        return [*found, f"rows {left.num_rows} <> {right.num_rows}"]
    a, b = _rows(left, names), _rows(right, names)
    unequal = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if unequal:
        found.append(f"{len(unequal)} of {len(a)} rows differ, first: {[c[1] for c in unequal[0][0]]} <> {[c[1] for c in unequal[0][1]]}")
    if left.num_rows == 0:
        found.append("no rows on either side")
    return found


def main() -> None:
    from checks import catalog
    from parcelframe.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--data", default="/root/testdata/sf0.01")
    parser.add_argument("--limit", type=int, default=1800, help="seconds per query")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark: SparkSession = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(args.data)
    failed = 0

    def stop(*_):
        raise TimeoutError("over the time limit")

    signal.signal(signal.SIGALRM, stop)
    for name in args.names or catalog.QUERIES:
        started = time.time()
        signal.alarm(args.limit)
        try:
            frame = catalog.QUERIES[name](spark, args.data)
            if name in catalog.SQL:
                found = differences(frame, connection, catalog.SQL[name])
            else:
                count = len(frame.collect())
                found = [] if count else ["no rows"]
        except Exception as error:  # noqa: BLE001 - a report lists every failure
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        signal.alarm(0)
        if any("TimeoutError" in f for f in found):
            spark.sparkContext.cancelAllJobs()
        failed += bool(found)
        print(f"{'ok  ' if not found else 'FAIL'} {time.time() - started:6.2f}s {name} {' | '.join(found)}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
