"""Equi joins that hold up when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.rows import earliest_per_key, lowest_per_key


def _sorts_by_text(rows: DataFrame, lookup: DataFrame, on: Sequence[str]) -> bool:
    """The first key is text, and equal keys hash alike because their types are the same."""
    types = [(rows.schema[key].dataType, lookup.schema[key].dataType) for key in on]
    return types[0][0] == T.StringType() and all(left == right for left, right in types)


def key_join(
    rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner", shuffled: bool = False
) -> DataFrame:
    """Join on equal column names; `how` is one of inner, left, left_semi, left_anti.

    Nothing is measured while the query is built. Adaptive execution sees the real size of each
    shuffled side: it sends a small `lookup` to every task, and it splits a partition that a
    heavy key has made too large by map output, so that even equal rows go to several tasks.
    `shuffled` asks for the shuffled join whatever the sizes.
    """
    left, right, by = rows, lookup.hint("merge") if shuffled else lookup, list(on)
    if _sorts_by_text(rows, lookup, on):
        # A number to compare first: the sort of a text key compares whole texts far less often.
        left, right = (side.withColumn("_hash", F.xxhash64(*on)) for side in (left, right))
        by = ["_hash", *by]
    extra = [] if how in ("left_semi", "left_anti") else [c for c in lookup.columns if c not in on]
    return left.join(right, by, how).select(*rows.columns, *extra)


def match_catalogue(
    events: DataFrame,
    catalogue: DataFrame,
    on: Mapping[str, str],
    take: Sequence[str],
    how: str = "left",
    round_to: Mapping[str, int] | None = None,
    one_match: str | None = None,
    shuffled: bool = False,
) -> DataFrame:
    """Adds the `take` columns of the matching catalogue rows to each event.

    `on` maps event columns to catalogue columns. `round_to` compares an event column as a
    number with that many decimals on both sides. `one_match` keeps only the catalogue row
    with the lowest value of that column per key, so an event never matches twice. `shuffled`
    is as for `key_join`.
    """
    round_to = round_to or {}
    names = {event: f"_key_{n}" for n, event in enumerate(on)}
    keys = list(names.values())

    def compared(columns: Mapping[str, str]) -> list[Column]:
        return [
            (F.round(column, round_to[event]) if event in round_to else F.col(column)).alias(
                names[event]
            )
            for event, column in columns.items()
        ]

    of_events = compared({event: event for event in on})
    lookup = records = catalogue.select(*compared(on), *take).dropna(subset=keys)
    if one_match:
        lookup = (
            lowest_per_key(records, keys, one_match)
            if list(take) == [one_match]
            else earliest_per_key(records, keys, [one_match])
        )
    return key_join(events.select("*", *of_events), lookup, keys, how, shuffled).drop(*keys)


def star_join(fact: DataFrame, *dimensions: tuple[DataFrame, str, str]) -> DataFrame:
    """Fact joined to each (dimension, fact key, dimension key) in turn.

    No hint: Catalyst broadcasts the dimensions that its size estimate, and later the
    measured shuffle size, put under the threshold; it shuffles the others, where AQE
    splits partitions that a heavy key has made too large.
    """
    return reduce(
        lambda rows, d: rows.join(d[0], F.col(d[1]) == F.col(d[2])), dimensions, fact
    )


def first_joined(
    fact: DataFrame, dimensions: Sequence[tuple[DataFrame, str, str]], n: int, *order: Column
) -> DataFrame:
    """The first n rows of `star_join` in an order that uses fact columns only.

    An inner join only drops or repeats rows. So the first n fact rows that have a match in every
    dimension give all of the answer, and only these are joined to whole dimension rows.
    """
    matched = reduce(
        lambda rows, d: rows.join(d[0].select(F.col(d[2])), F.col(d[1]) == F.col(d[2]), "left_semi"),
        dimensions,
        fact,
    )
    return star_join(matched.orderBy(*order).limit(n), *dimensions).orderBy(*order).limit(n)
