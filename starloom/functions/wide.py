"""Sums across the columns of a row, and rates."""

from __future__ import annotations

import re
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def columns_matching(rows: DataFrame, pattern: str = "_") -> list[str]:
    return [name for name in rows.columns if re.search(pattern, name)]


def row_sum(names: list[str], nulls: str = "propagate") -> Column:
    """Sum of the named columns of each row, as double.

    Text that is no number counts as null. `nulls` says what a null does: "propagate"
    makes the sum null, "zero" counts it as 0.
    """
    if nulls not in ("propagate", "zero"):
        raise ValueError(f"nulls must be 'propagate' or 'zero', not {nulls!r}")
    numbers = [F.expr(f"try_cast(`{name}` AS double)") for name in names]
    if nulls == "zero":
        numbers = [F.coalesce(number, F.lit(0.0)) for number in numbers]
    return reduce(add, numbers)


def percent_improvement(before: Column, after: Column) -> Column:
    """How much smaller `after` is, in percent of `before`; null when `before` is 0."""
    return F.try_divide(F.lit(100.0) * (before - after), before)
