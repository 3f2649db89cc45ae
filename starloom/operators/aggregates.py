"""Counts, sums and summaries per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_rows(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(*columns).distinct()


def count_by(rows: DataFrame, *keys: Column | str, name: str = "count") -> DataFrame:
    """Row count per group, the largest group first."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.desc(name), *[c for c in counts.columns if c != name])


def exact_sum(value: Column, decimals: int) -> Column:
    """Sum of numbers that are declared to have that many decimals, given as double: the same to
    the last digit in whatever order the rows come, unlike a sum of doubles.

    Nothing is rounded away: a value with more decimals than declared, beyond the noise of a
    double, is an error. Adds whole units as bigint, several times as fast as decimals. The upper
    and lower bits are added apart, so that trillions of rows do not overflow.
    """
    scaled = value * 10**decimals
    noise = F.lit(1e-6) + F.abs(scaled) * F.lit(1e-12)
    refused = F.raise_error(F.concat(F.lit(f"more than {decimals} decimals: "), value.cast("string")))
    units = F.when(F.abs(scaled - F.rint(scaled)) > noise, refused.cast("bigint")).otherwise(
        F.rint(scaled).cast("bigint")
    )
    upper, lower = F.shiftright(units, 20), units.bitwiseAND(F.lit(2**20 - 1))
    total = F.sum(upper).cast("decimal(38,0)") * F.lit(2**20) + F.sum(lower)
    return (total / F.lit(10**decimals)).cast("double")


def sum_by(rows: DataFrame, value: Column, *keys: Column | str, name: str = "revenue") -> DataFrame:
    return rows.groupBy(*keys).agg(value.alias(name))


def sum_by_month(
    rows: DataFrame,
    moment: str,
    amount: Column,
    year: str = "y",
    month: str = "m",
    decimals: int | None = None,
) -> DataFrame:
    """Amounts are added as they are; with `decimals` declared, exactly."""
    total = F.sum(amount) if decimals is None else exact_sum(amount, decimals)
    return rows.groupBy(F.year(moment).alias(year), F.month(moment).alias(month)).agg(
        total.alias("revenue")
    )


def fact_summary(rows: DataFrame, fact: str, by: str, decimals: int | None = None) -> DataFrame:
    """max, min and average of one column per group, named after the column."""
    average = F.avg(fact) if decimals is None else F.round(F.avg(fact), decimals)
    return rows.groupBy(by).agg(
        F.max(fact).alias(f"max_{fact}"),
        F.min(fact).alias(f"min_{fact}"),
        average.alias(f"average_{fact}"),
    )


def _leading_counts(rows: DataFrame, key: str, places: int) -> tuple[DataFrame, DataFrame]:
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("num"))
    leading = counts.select("num").distinct().orderBy(F.desc("num")).limit(places)
    return counts, leading


def groups_with_ties(rows: DataFrame, key: str, places: int) -> DataFrame:
    """The groups that have one of the `places` highest row counts: a row (num, member) each."""
    counts, leading = _leading_counts(rows, key, places)
    return counts.join(F.broadcast(leading), "num", "left_semi").select(
        "num", F.col(key).cast("string").alias("member")
    )


def listed(groups: DataFrame) -> DataFrame:
    """Rows (num, member) as one text per num. Only for keys known to be few, such as years."""
    members = F.array_sort(F.collect_list("member"))
    return groups.groupBy("num").agg(F.array_join(members, ", ").alias("members"))


def positions(rows: DataFrame, key: str, places: int) -> DataFrame:
    """One row per group in the first `places` positions; equal counts share a position.

    The position is worked out on the few leading counts, not over all groups.
    """
    counts, leading = _leading_counts(rows, key, places)
    ranked = leading.agg(F.sort_array(F.collect_list("num"), asc=False).alias("nums")).select(
        F.posexplode("nums").alias("place", "num")
    )
    return counts.join(F.broadcast(ranked), "num").select(
        (F.col("place") + 1).alias("position"), key, "num"
    )
