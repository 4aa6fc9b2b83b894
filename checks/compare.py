"""Run the registered queries next to their SQL: ``python -m checks.compare [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from reviewlab.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """An in-process connection with the test tables as views."""
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def canonical(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, list):
        return tuple(canonical(item) for item in value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(row[i]) for i in order) for row in rows)


def compare(spark, connection, folder: str, name: str) -> tuple[float, str]:
    """Seconds Spark took, and an empty string if both engines agree, else what differs."""
    start = time.time()
    result = QUERIES[name](spark, folder)
    mine = rows_of(result.columns, [tuple(row) for row in result.collect()])
    return time.time() - start, difference(connection, name, result.columns, mine)


def difference(connection, name: str, columns: list[str], mine: Counter) -> str:
    if name not in ORACLE:
        return "" if mine else "no rows"
    relation = connection.sql(ORACLE[name])
    if sorted(columns) != sorted(relation.columns):
        return f"columns {sorted(columns)} != {sorted(relation.columns)}"
    theirs = rows_of(relation.columns, relation.fetchall())
    if mine == theirs:
        return ""
    only_mine, only_theirs = mine - theirs, theirs - mine
    return (
        f"rows {sum(mine.values())} / {sum(theirs.values())}, "
        f"only spark {str(list(only_mine.items())[:2])[:300]}, "
        f"only sql {str(list(only_theirs.items())[:2])[:300]}"
    )


def main(scale: str, names: list[str]) -> int:
    folder = f"/root/testdata/sf{scale}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failures = 0
    for name in names or QUERIES:
        start = time.time()
        seconds, message = compare(spark, connection, folder, name)
        failures += bool(message)
        kind = "sql " if name in ORACLE else "rows"
        other = time.time() - start - seconds
        print(f"{seconds:7.2f} {other:7.2f} {kind} {name}: {message or 'ok'}", flush=True)
    return failures


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1] if len(sys.argv) > 1 else "0.01", sys.argv[2:]))
