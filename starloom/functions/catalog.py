"""The library's functions under names that SQL can call.

Their bodies are SQL expressions that Spark expands where they are called: nothing runs in Python,
and a call is planned as if it were written out.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from starloom.functions import weblog

_FIELDS = ", ".join(f"{name} STRING" for name in weblog.FIELDS)


def _bodies() -> dict[str, str]:
    """Signature and result type to body. A line is taken apart once a call."""
    parts = f"split(regexp_replace(line, r'{weblog.LINE}', '{weblog.MARKED}'), '{weblog.MARK}')"
    count = len(weblog.FIELDS)
    names = ", ".join(f"'{name}'" for name in weblog.FIELDS)
    as_map = f"transform(array({parts}), p -> if(size(p) = {count}, map_from_arrays(array({names}), p), NULL))[0]"
    fields = ", ".join(f"'{name}', p[{n}]" for n, name in enumerate(weblog.FIELDS))
    as_struct = f"transform(array({parts}), p -> if(size(p) = {count}, named_struct({fields}), NULL))[0]"
    return {
        "log_fields(line STRING) RETURNS MAP<STRING, STRING>": as_map,
        f"log_line(line STRING) RETURNS STRUCT<{_FIELDS.replace(' STRING', ': STRING')}>": as_struct,
        "random_key() RETURNS STRING": "uuid()",
        "hash_key(parts ARRAY<STRING>) RETURNS STRING": "md5(array_join(transform(parts, p -> coalesce(p, '')), '|'))",
    }


def register(spark: SparkSession, database: str | None = None) -> list[str]:
    """Makes the functions known to SQL and gives their names.

    Without a database they are temporary and go with the session; with one they are stored in
    the catalog for every session that uses it.
    """
    names = []
    for signature, body in _bodies().items():
        name = signature.partition("(")[0]
        names.append(f"{database}.{name}" if database else name)
        if database:
            spark.sql(f"DROP FUNCTION IF EXISTS {database}.{name}")
            spark.sql(f"CREATE FUNCTION {database}.{signature} RETURN {body}")
        else:
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return names
