"""Values that run along the rows of a key, with RANGE frames from the start to the current row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_JOIN = {"sum": lambda a, b: a + b, "count": lambda a, b: a + b, "min": F.least, "max": F.greatest}


@dataclass(frozen=True)
class Running:
    """What runs: "sum", "count", "min", "max" or "last" of a column.

    "last" is the last value of the frame that is not null. Of rows at the same moment, the one
    with the lowest `ties` column counts.
    """

    kind: str
    column: str
    ties: str | None = None


def running(
    rows: DataFrame,
    keys: Sequence[str],
    moment: str,
    values: Mapping[str, Running],
    descending: bool = False,
    piece: str = "day",
) -> DataFrame:
    """Adds columns as `agg(column) over (partition by keys order by moment range between unbounded
    preceding and current row)` gives them: rows of the same moment have the same frame.

    A key's rows are first reduced to one row a moment, on the map side as well, then cut into
    pieces of time (`piece` as for `date_trunc`), so that a key with a third of all rows runs in many
    tasks. Each piece starts from what the pieces before it add up to: one row a key and
    piece. Null keys are a key, rows without a moment come first, as in SQL windows (last if
    descending). Nothing is read twice but the rows themselves, which take up the values of
    their moment by a join that adaptive execution splits for heavy keys.
    """
    keys, names = list(keys), list(values)
    kinds = {name: _kind(value, descending) for name, value in values.items()}
    at_moment = [_at_moment(value, moment, descending).alias(name) for name, value in values.items()]
    moments = rows.groupBy(*keys, moment).agg(*at_moment).withColumn("_piece", F.date_trunc(piece, F.col(moment)))

    def order(column: str) -> Column:
        return F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_first()

    total = [_total(kinds[name])(name).alias(name) for name in names]
    earlier = Window.partitionBy(*keys).orderBy(order("_piece")).rowsBetween(Window.unboundedPreceding, -1)
    carried = moments.groupBy(*keys, "_piece").agg(*total).select(
        *[F.col(key).alias(f"_key_{n}") for n, key in enumerate(keys)],
        F.col("_piece").alias("_of_piece"),
        *[_total(kinds[name])(name).over(earlier).alias(f"_before_{name}") for name in names],
    )
    inside = Window.partitionBy(*keys, "_piece").orderBy(order(moment)).rowsBetween(Window.unboundedPreceding, 0)
    local = moments.select(*keys, moment, "_piece", *[_total(kinds[name])(name).over(inside).alias(name) for name in names])
    same_piece = [F.col(key).eqNullSafe(F.col(f"_key_{n}")) for n, key in enumerate(keys)] + [
        F.col("_piece").eqNullSafe(F.col("_of_piece"))
    ]
    whole = local.join(carried, _all(same_piece)).select(
        *[F.col(key).alias(f"_at_{n}") for n, key in enumerate([*keys, moment])],
        *[_result(values[name], _joined(kinds[name], f"_before_{name}", name)).alias(name) for name in names],
    )
    same_moment = [F.col(key).eqNullSafe(F.col(f"_at_{n}")) for n, key in enumerate([*keys, moment])]
    return rows.join(whole, _all(same_moment)).select(*rows.columns, *names)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _kind(value: Running, descending: bool) -> str:
    """The last of a frame is the highest of its moments, or the lowest if they run down."""
    if value.kind == "last":
        return "min" if descending else "max"
    if value.kind not in _JOIN:
        raise ValueError(f"{value.kind} does not run")
    return value.kind


def _total(kind: str):
    return {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}[kind]


def _at_moment(value: Running, moment: str, descending: bool) -> Column:
    if value.kind == "last":
        known = F.col(value.column).isNotNull()
        picked = F.min(value.column)
        if value.ties:
            picked = F.min(F.when(known, F.struct(value.ties, value.column))).getField(value.column)
        # rows without a moment come first; a flag keeps them in order among the others
        dated = F.col(moment).isNotNull()
        found = F.struct(dated.alias("dated"), F.col(moment).alias("moment"), picked.alias("value"))
        return F.when(F.count(value.column) > 0, found)
    return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[value.kind](value.column)


def _joined(kind: str, before: str, name: str) -> Column:
    both = _JOIN[kind](F.col(before), F.col(name))
    return F.coalesce(both, F.col(before), F.col(name))


def _result(value: Running, joined: Column) -> Column:
    return joined.getField("value") if value.kind == "last" else joined
