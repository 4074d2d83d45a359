"""Run registered queries against their SQL in DuckDB: ``python -m checks.verify [folder] [name...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

from checks.registry import QUERIES, SQL


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("rainpanel-checks")
        .config("spark.sql.shuffle.partitions", cores).config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rainpanel-checkpoint-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def table(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(normal(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con, folder: str, name: str, queries=QUERIES, sql=SQL) -> tuple[bool, str]:
    df = queries[name](spark, folder)
    columns, rows = table(df.columns, df.collect())
    if name not in sql:
        return bool(rows), f"{len(rows)} rows, no SQL"
    result = con.execute(sql[name])
    expected_columns, expected = table([d[0] for d in result.description], result.fetchall())
    if columns != expected_columns:
        return False, f"columns {columns} != {expected_columns}"
    if len(rows) != len(expected):
        return False, f"{len(rows)} rows, expected {len(expected)}"
    wrong = [(a, b) for a, b in zip(rows, expected) if a != b]
    if wrong:
        return False, f"{len(wrong)} of {len(rows)} rows differ, first: {wrong[0][0]} expected {wrong[0][1]}"
    return bool(rows), f"{len(rows)} rows equal"


def main(arguments: list[str]) -> int:
    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark, con, failed = session(), database(folder), []
    for name in arguments[1:] or QUERIES:
        start = time.time()
        try:
            good, message = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            good, message = False, f"{type(error).__name__}: {str(error)[:600]}"
            con = database(folder)
        if not good:
            failed.append(name)
        print(f"{'ok  ' if good else 'FAIL'} {name:32s} {time.time() - start:6.2f}s {message}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
