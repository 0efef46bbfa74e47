"""Run registered queries and their SQL side by side and report what differs.

    python -m checks.compare [--dir /root/testdata/sf0.01] [--cpus 8] [name ...]
"""

from __future__ import annotations

import argparse
import math
import time

import duckdb

from bidscope.plans.registered import queries
from bidscope.session import build_session
from checks.oracles import oracle_sql

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _cell(value: object) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(got: tuple[list[str], list[tuple]], want: tuple[list[str], list[tuple]]) -> str | None:
    """None where both results hold the same columns and the same rows in any order."""
    if sorted(got[0]) != sorted(want[0]):
        return f"columns {sorted(set(got[0]) ^ set(want[0]))}"
    left, right = rows_of(*got), rows_of(*want)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(left)} rows differ, first: {sorted(got[0])} {wrong[0]}" if wrong else None


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("--cpus", default="8")
    options = parser.parse_args()
    spark = build_session(
        "compare",
        f"local[{options.cpus}]",
        {
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": options.cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    oracle, connection = oracle_sql(), connect(options.dir)
    failures = 0
    for name, query in queries().items():
        if options.names and name not in options.names:
            continue
        try:
            start = time.time()
            result = query(spark, options.dir)
            got = (result.columns, [tuple(row) for row in result.collect()])
            spent = time.time() - start
            if name not in oracle:
                print(f"rows-only {name}: {len(got[1])} rows, {spent:.2f}s", flush=True)
                continue
            answer = connection.execute(oracle[name])
            columns = [c[0] for c in answer.description]
            problem = difference(got, (columns, answer.fetchall()))
        except Exception as error:  # noqa: BLE001 - every query is reported
            problem, spent = f"{type(error).__name__}: {str(error)[:1500]}", time.time() - start
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {spent:.2f}s {problem or len(got[1])}", flush=True)
    print(f"{failures} failed")


if __name__ == "__main__":
    main()
