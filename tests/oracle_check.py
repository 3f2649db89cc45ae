"""Runs queries next to their SQL equivalents and compares names, types and exact values.

    python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
from datetime import date, datetime

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.schemas import GIVEN_TABLES  # noqa: E402

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in GIVEN_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return repr(value)


def differences(frame, connection, sql: str) -> list[str]:
    """What differs between a frame and the SQL result; an empty list if nothing does."""
    cursor = connection.execute(sql)
    expected_types = {d[0]: str(d[1]) for d in cursor.description}
    names = sorted(expected_types)
    order = [list(expected_types).index(name) for name in names]
    expected = sorted([_plain(row[n]) for n in order] for row in cursor.fetchall())
    found = []
    if sorted(frame.columns) != names:
        return [f"columns {sorted(frame.columns)} should be {names}"]
    for name, kind in frame.dtypes:
        if TYPES.get(kind) != expected_types[name]:
            found.append(f"{name} is {kind}, should be {expected_types[name]}")
    actual = sorted([_plain(v) for v in row] for row in frame.select(*names).collect())
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows, should be {len(expected)}")
    elif actual != expected:
        wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
        found.append(f"{len(wrong)} rows differ, the first: {wrong[0]}")
    return found


def main() -> int:
    import time

    import __spark_entry__ as entry_module
    from starloom.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracle check", "local[8]", settings={"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        if name in oracles:
            found = differences(queries[name](spark, folder), connection, oracles[name])
        else:
            found = [f"no SQL; {queries[name](spark, folder).count()} rows"]
        bad += name in oracles and bool(found)
        print(f"{'ok' if not found else found}  {name}  {time.time() - start:.2f}s", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
