"""Run registered queries and their SQL side by side and report differences.

    python tools/compare.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from catalogue import ORACLES, QUERIES  # noqa: E402

EMPTY: set[str] = set()  # queries whose result is an empty table


def duck_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(os.listdir(folder)):
        name = f.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{f}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else repr(value))
    return (type(value).__name__, str(value))


def table_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns by name and rows in a fixed order, with the type of every value."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str) -> str | None:
    df = QUERIES[name](spark, folder)
    ours = table_of(df.columns, df.collect())
    if name not in ORACLES:
        return None
    found = con.execute(ORACLES[name])
    theirs = table_of([d[0] for d in found.description], found.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows against {len(theirs[1])}: {ours[1][:1]} {theirs[1][:1]}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            return "; ".join(f"{c}: {x} against {y}" for c, x, y in zip(ours[0], a, b) if x != y)
    return None if ours[1] or name in EMPTY else "no rows"


def main(folder: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connection(folder)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = differences(spark, con, folder, name)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} of {len(names or QUERIES)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
