"""Projections, filters and one-row-per-key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def renamed(rows: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Only the named columns, under their new names; `names` maps source to result."""
    return rows.select(*[F.col(source).alias(result) for source, result in names.items()])


def where_value(rows: DataFrame, column: str, value) -> DataFrame:
    """Rows whose column has the value, or one of the values of a list."""
    if isinstance(value, (list, tuple, set, frozenset)):
        return rows.where(F.col(column).isin(*value))
    return rows.where(F.col(column) == F.lit(value))


def with_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows in which every key is there: not null, and not empty if it is text."""
    for key in keys:
        present = F.col(key).isNotNull()
        if rows.schema[key].dataType.typeName() == "string":
            present = F.col(key) != ""
        rows = rows.where(present)
    return rows


def _pick(rows: DataFrame, keys: Sequence[str], order: Sequence[str], choose) -> DataFrame:
    rest = [name for name in rows.columns if name not in keys and name not in order]
    row = choose(F.struct(*order, *rest)).alias("_row")
    return rows.groupBy(*keys).agg(row).select(
        *[F.col(name) if name in keys else F.col(f"_row.{name}") for name in rows.columns]
    )


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the highest `order` for every key.

    An aggregate, so every map task sends at most one row per key: a key that holds a third of
    the table costs no more than any other. Among rows with the same `order` the highest of the
    other columns counts, so the choice is the same on every run.
    """
    return _pick(rows, keys, order, F.max)


def earliest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the lowest `order` for every key; see `latest_per_key`.

    The same row that `last` over a descending frame up to the current row gives at the
    first row of a key, without bringing the rows of a key together.
    """
    return _pick(rows, keys, order, F.min)


def lowest_per_key(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys with their lowest `value`, for lookups where any match will do."""
    return rows.groupBy(*keys).agg(F.min(value).alias(value))


def top_rows(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows in the given order: each task keeps n rows, no full sort."""
    return rows.orderBy(*order).limit(n)
