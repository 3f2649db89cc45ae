"""Merges of a batch into a target, as plain functions from two frames to the merged frame.

Parquet tables take no MERGE or DELETE, so each merge is an anti join and a union. A merge
that runs twice with the same batch gives the same table: keys are compared null-safe, so a
null key is a key as any other. The sinks decide how the result
replaces the stored table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.rows import earliest_per_key, latest_per_key


def _matching(
    rows: DataFrame, others: DataFrame, keys: Sequence[str], how: str, shuffled: bool = True
) -> DataFrame:
    """A shuffled join whatever the sizes, if not told otherwise: batches and targets grow with the
    input, and a load has many merges, whose keys would all go through the driver if broadcast."""
    named = others.select(*[F.col(key).alias(f"_other_{key}") for key in keys])
    named = named.hint("merge") if shuffled else named
    same = [F.col(key).eqNullSafe(F.col(f"_other_{key}")) for key in keys]
    return rows.join(named, reduce(lambda a, b: a & b, same), how)


def without_keys(
    rows: DataFrame, others: DataFrame, keys: Sequence[str], shuffled: bool = True
) -> DataFrame:
    """Rows whose key does not occur in `others`. Adaptive execution splits a heavy key of `rows`
    over several tasks; if not `shuffled`, it sends few others to every task."""
    return _matching(rows, others, keys, "left_anti", shuffled)


def upsert_update(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Update on conflict: a key of the batch takes the batch row, the latest if there are several.

    `order` may name batch columns that the target does not have.
    """
    latest = latest_per_key(batch, keys, order).select(*target.columns)
    return without_keys(target, latest, keys).unionByName(latest)


def unseen(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a batch without repeated keys whose key the target does not have.

    Of the target only the keys are read, and only those of the batch go on: what is left to
    compare is no larger than the batch.
    """
    return without_keys(batch, _matching(target.select(*keys), batch, keys, "left_semi"), keys)


def new_rows(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """As `unseen`, for a batch that may repeat a key: the earliest row of each key."""
    return unseen(target, earliest_per_key(batch, keys, order).select(*target.columns), keys)


def upsert_ignore(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Ignore on conflict: a key that the target has keeps its row."""
    return target.unionByName(new_rows(target, batch, keys, order))


def fact_append(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Append that can be repeated: facts the target already has are not added again."""
    return upsert_ignore(target, batch, keys, order)


def delete_then_insert(
    target: DataFrame, staged: DataFrame, insert: DataFrame, keys: Sequence[str], shuffled: bool = False
) -> DataFrame:
    """Drops the target rows whose key was staged, then adds the distinct rows of `insert`.

    A null key deletes nothing. The target may hold many rows per key: partitions that a heavy key makes too large are split
    at run time. `shuffled` asks for the shuffled join whatever the sizes.
    """
    named = staged.select(*keys).dropna().distinct()
    kept = without_keys(target, named, keys, shuffled)
    return kept.unionByName(insert.select(*target.columns).distinct())
