"""Run the registered queries beside their SQL oracles.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def normalised(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(_value(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(values, key=repr)


def difference(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a Spark result and an oracle's, or None."""
    columns, found = normalised(frame.columns, frame.collect())
    cursor = connection.execute(sql)
    names = [item[0] for item in cursor.description]
    expected_columns, expected = normalised(names, cursor.fetchall())
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if len(found) != len(expected):
        extra = set(found) - set(expected)
        missing = set(expected) - set(found)
        return f"rows {len(found)} != {len(expected)}; extra {list(extra)[:2]}; missing {list(missing)[:2]}"
    for one, other in zip(found, expected):
        if one != other:
            return f"{one!r} != {other!r}"[:600]
    return None


def main(folder: str, names: list[str]) -> int:
    from rotativa.queries import ORACLES, QUERIES
    from rotativa.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failures = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                frame = QUERIES[name](spark, folder)
                problem = difference(frame, connection, ORACLES[name])
                size = ""
            else:
                problem, size = None, f"{QUERIES[name](spark, folder).count()} rows, no oracle"
        except Exception as error:  # report and go on
            problem, size = f"{type(error).__name__}: {str(error)[-1800:]}", ""
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {size}{problem or ''}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    arguments = sys.argv[1:]
    sys.exit(1 if main(arguments[0] if arguments else "/root/testdata/sf0.01", arguments[1:]) else 0)
