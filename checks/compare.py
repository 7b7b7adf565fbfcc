"""Runs queries next to their SQL and reports differences.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession


def session(cores: str = "*") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("checks")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _rows(names: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


SAME_TYPE = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def difference(found: DataFrame, connection, sql: str) -> str | None:
    """None when names and rows agree, otherwise what differs."""
    expected = connection.execute(sql)
    names, want = _rows([c[0] for c in expected.description], expected.fetchall())
    have_names, have = _rows(found.columns, found.collect())
    if names != have_names:
        return f"columns {have_names} instead of {names}"
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    types = {name: kind for name, kind, *_ in described}
    other = {n: (k, types[n]) for n, k in found.dtypes if SAME_TYPE.get(k) != types[n]}
    if other:
        return f"types {other}"
    if want == have:
        return None
    surplus, missing = have - want, want - have
    return (
        f"{sum(have.values())} rows instead of {sum(want.values())};"
        f" {sum(surplus.values())} surplus {list(surplus)[:2]},"
        f" {sum(missing.values())} missing {list(missing)[:2]}"
    )


def main(arguments: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from checks.oracle import oracle
    from checks.queries import queries

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    wanted = arguments[1:] or list(queries())
    spark, connection, sql = session(), duck(sf_dir), oracle()
    failed = 0
    for name in wanted:
        started = time.time()
        try:
            problem = difference(queries()[name](spark, sf_dir), connection, sql[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:26s} {time.time() - started:6.1f}s  {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
