"""Row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def hash_key(*columns: Column | str, separator: str = "|") -> Column:
    """md5 over the values with a separator between them; a null counts as an empty value.

    The same row always gets the same key, on every run and after a task is retried.
    """
    parts = [F.coalesce(_column(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws(separator, *parts))


def random_key() -> Column:
    """A fresh id per row. It changes on every evaluation: write it out before using it twice."""
    return F.uuid()


def joined_text(*columns: Column | str, separator: str = " ") -> Column:
    """Values with a separator between them, nulls left out."""
    return F.concat_ws(separator, *[_column(c) for c in columns])
