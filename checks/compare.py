"""Run registered queries and their SQL side by side and compare the results.

    python -m checks.compare <scale directory> [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import oracle_sql
from checks.registry import queries


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark: SparkSession, sf_dir: str, names: list[str]) -> int:
    con, sqls, failures = database(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        df = fn(spark, sf_dir)
        got = rows_of(df.columns, df.collect())
        took = time.time() - started
        started = time.time()
        result = con.execute(sqls[name])
        columns = [d[0] for d in result.description]
        want = rows_of(columns, result.fetchall())
        same = sorted(df.columns) == sorted(columns) and got == want
        failures += not same
        print(f"{'ok  ' if same else 'DIFF'} {name:30s} {len(got):7d} rows  spark {took:5.1f} s  sql {time.time() - started:5.1f} s", flush=True)
        if not same:
            print("   columns", sorted(df.columns), sorted(columns))
            left, right = set(got) - set(want), set(want) - set(got)
            print("   rows", len(got), len(want), "only spark", len(left), "only sql", len(right))
            print("   e.g.", sorted(left)[:2], sorted(right)[:2])
        spark.catalog.clearCache()
    return failures


if __name__ == "__main__":
    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    sys.exit(min(1, compare(session, sys.argv[1], sys.argv[2:])))
