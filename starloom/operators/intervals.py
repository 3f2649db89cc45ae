"""Joins of points with the intervals that they lie in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Positions are taken modulo this reach: 2^23 days are 23,000 years.
BITS = 23


def _cover(first: Column, last: Column, bits: int) -> Column:
    """The fewest dyadic blocks (level, block) that make up the positions from first to last.

    A block of level k has 2^k positions. At each level there is one block at most at each end:
    the one that its parent, reaching over the end, cannot stand for.
    """

    def blocks(level: Column) -> Column:
        step = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        low = F.call_function("div", first + step - 1, step)
        end = F.call_function("div", last + 1, step)
        left = F.when((low < end) & (low % 2 == 1), F.struct(level.alias("level"), low.alias("block")))
        right = F.when((low < end) & (end % 2 == 1), F.struct(level.alias("level"), (end - 1).alias("block")))
        return F.array(left, right)

    found = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(bits)), blocks))
    return F.filter(found, lambda block: block.isNotNull())


def interval_join(
    points: DataFrame, at: Column, intervals: DataFrame, first: Column, last: Column, bits: int = BITS
) -> DataFrame:
    """Each point with each interval from `first` to `last`, both included, that it lies in.

    An equi join on (level, block): an interval of n positions is cut into 2 log2 n blocks at
    most, and a point looks up the one block it lies in at each level that there is. A match shows once.
    `at` is a whole number from -2^(bits-1) up to 2^(bits-1); null is in no interval. An end that
    is null is open. An interval that ends before it starts has no points. Hot blocks are split
    by adaptive execution as any hot key.
    """
    half = 1 << (bits - 1)
    low = F.greatest(F.coalesce(first.cast("bigint"), F.lit(-half)), F.lit(-half)) + half
    high = F.least(F.coalesce(last.cast("bigint"), F.lit(half - 1)), F.lit(half - 1)) + half
    cut = intervals.withColumn("_block", F.explode(_cover(low, high, bits)))
    # as many rows as there are levels, 24 at most
    levels = sorted(row.level for row in cut.select(F.col("_block.level").alias("level")).distinct().collect())
    position = at.cast("bigint") + half
    lies = F.array(
        *[
            F.struct(F.lit(level).alias("_level"), F.shiftright(position, level).alias("_number"))
            for level in levels
        ]
    )
    if not levels:
        lies = F.array().cast("array<struct<_level: int, _number: bigint>>")
    inside = (at >= -half) & (at < half)
    looked_up = points.withColumn("_lies", F.explode(F.when(inside, lies)))
    named = cut.withColumnsRenamed({name: f"_interval_{name}" for name in intervals.columns})
    same = (F.col("_lies._level") == F.col("_block.level")) & (F.col("_lies._number") == F.col("_block.block"))
    return looked_up.join(named, same).select(
        *points.columns, *[F.col(f"_interval_{name}").alias(name) for name in intervals.columns]
    )
