"""Web access log lines: host ident user [date] "method path protocol" status size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.calendar import parse_log_time

# The fields of a line, in order.
FIELDS = (
    "host",
    "client_identd",
    "user_id",
    "date_time",
    "method",
    "endpoint",
    "protocol",
    "response_code",
    "content_size",
)

LINE = (
    r'^(\S+) (\S+) (\S+) \[([^\]]*)\] "(\S+)\s*(.*?)\s*(HTTP/[0-9.]+)?\s*" ([0-9]{3}) (\S+)\s*$'
)
MARK = "\u0001"
MARKED = MARK.join(f"${n}" for n in range(1, len(FIELDS) + 1))


def fields_by_split(line: Column) -> dict[str, Column]:
    """First cut of a line: the host and size by position, from a plain split on blanks."""
    parts = F.split(line, " ")
    return {
        "host": F.get(parts, F.lit(0)),
        "content_size": F.get(parts, F.size(parts) - 1),
    }


def _parts(line: Column) -> Column:
    # One pass of the pattern per line: it rewrites the line to its nine fields, and a
    # cheap split takes them apart. Nine separate extractions would match nine times.
    return F.split(F.regexp_replace(line, LINE, MARKED), MARK)


def parse_to_map(lines: DataFrame, line: str = "value", into: str = "parsed") -> DataFrame:
    """Adds a map from field name to text; null for a line that does not fit the layout."""
    names = F.array(*[F.lit(name) for name in FIELDS])
    marked = lines.withColumn("_parts", _parts(F.col(line)))
    fits = F.size("_parts") == len(FIELDS)
    return marked.withColumn(
        into, F.when(fits, F.map_from_arrays(names, F.col("_parts")))
    ).drop("_parts")


def map_to_columns(rows: DataFrame, field_names=FIELDS, parsed: str = "parsed") -> DataFrame:
    """One column per map key; a key that is missing gives null."""
    return rows.selectExpr(*[f"{parsed}['{name}'] AS {name}" for name in field_names])


def parse_lines(lines: DataFrame, line: str = "value") -> tuple[DataFrame, DataFrame]:
    """Lines that fit, as nine text columns, and the lines that do not."""
    # The parts come out of a generator, below which no filter on them can be copied: the
    # pattern runs once a line.
    marked = lines.select(
        F.col(line).alias("line"), F.explode_outer(F.array(_parts(F.col(line)))).alias("_parts")
    )
    fits = F.coalesce(F.size("_parts") == len(FIELDS), F.lit(False))
    rows = marked.where(fits).select(
        *[F.get("_parts", F.lit(n)).alias(name) for n, name in enumerate(FIELDS)]
    )
    return rows, marked.where(~fits).select("line")


def typed(rows: DataFrame) -> DataFrame:
    """Adds the size in bytes and the time; `-` and other text that is no number give null."""
    return rows.withColumns(
        {
            "content_size_bytes": F.expr("try_cast(content_size AS bigint)"),
            "logged_at": parse_log_time(F.col("date_time")),
        }
    )
