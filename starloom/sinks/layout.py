"""Physical layout: distribution keys, sort keys and replicated dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_bucketed(
    rows: DataFrame, name: str, key: str, buckets: int, sort_by: Sequence[str] = ()
) -> None:
    """A table distributed by a key: tables with the same buckets join on it without a shuffle.

    The rows are shuffled to their buckets first, so a bucket is one file instead of one per
    writing task. A bucket is read by one task: who gives a table buckets says that no value of
    the key is too heavy for one. A key with heavy values is for `write_sorted`, whose joins
    shuffle and split such values at run time.
    """
    spread = rows.repartition(buckets, F.col(key))
    spread.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(
        *(list(sort_by) or [key])
    ).saveAsTable(name)


def write_sorted(rows: DataFrame, name: str, *sort_by: str) -> None:
    """A table sorted on its key across all files, so that a filter on the key skips files.

    Rows with the same key are told apart by a hash of the row when they are divided over the
    tasks, so a key with many rows is spread over several of them.
    """
    hashed = [f.name for f in rows.schema.fields if not isinstance(f.dataType, T.MapType)]
    spread = rows.repartitionByRange(*sort_by, F.xxhash64(*hashed))
    spread.sortWithinPartitions(*sort_by).write.mode("overwrite").format("parquet").saveAsTable(
        name
    )


#: Rows of a dimension that is copied to every task; a row of ten columns takes some 200 bytes there.
MOST_REPLICATED = 500_000


def replicated(dimension: DataFrame, most_rows: int = MOST_REPLICATED) -> DataFrame:
    """A dimension that is copied to every task if it is found to have no more rows than that.

    Rows are counted up to the limit first. Beyond it the dimension stays as it is: it is joined by
    a shuffle, or as adaptive execution finds fit.
    """
    fits = dimension.limit(most_rows + 1).count() <= most_rows
    return F.broadcast(dimension) if fits else dimension


def write_curved(rows: DataFrame, name: str, *keys: str, bits: int = 10) -> None:
    """A table in the order of a curve through all keys at once (Z-order), so that a filter on any
    one of them skips files and row groups, not only one on the first.

    A key counts by its place among 2^bits quantiles of its values, found by one approximate pass
    over all keys; the bits of the places, taken in turn, give the place on the curve. Nulls come
    first. Rows of one place are told apart by a hash, so heavy keys spread over several tasks.
    """
    numbers = [_number(rows, key).alias(key) for key in keys]
    steps = [k / (1 << bits) for k in range(1, 1 << bits)]
    # 2^bits - 1 numbers a key, whatever the table
    quantiles = rows.select(*numbers).approxQuantile(list(keys), steps, 1 / (1 << (bits + 1)))
    places = [_place(_number(rows, key), sorted(set(cuts)), bits) for key, cuts in zip(keys, quantiles)]
    hashed = [f.name for f in rows.schema.fields if not isinstance(f.dataType, T.MapType)]
    placed = rows.withColumn("_curve", interleaved(places, bits))
    spread = placed.repartitionByRange("_curve", F.xxhash64(*hashed)).sortWithinPartitions("_curve", *keys)
    spread.drop("_curve").write.mode("overwrite").format("parquet").saveAsTable(name)


def _number(rows: DataFrame, key: str) -> Column:
    """The key as a number in the same order. Texts go by their first six bytes."""
    kind = rows.schema[key].dataType
    if isinstance(kind, T.StringType):
        return F.conv(F.hex(F.rpad(F.substring(F.col(key).cast("binary"), 1, 6), 6, F.lit(b"\0"))), 16, 10).cast("double")
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        return F.col(key).cast("timestamp").cast("double")
    return F.col(key).cast("double")


def _place(number: Column, cuts: list[float], bits: int) -> Column:
    """How many of the cuts are not above the number, by halving."""
    table = F.array(*[F.lit(cut) for cut in cuts + [float("inf")] * ((1 << bits) - 1 - len(cuts))])
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(bits))])
    further = lambda place, step: F.when(F.get(table, place + step - 1) <= number, place + step).otherwise(place)
    return F.aggregate(steps, F.lit(0), further).cast("bigint")


def interleaved(places: Sequence[Column], bits: int) -> Column:
    """One number from the bits of several, the highest of each first, in turn."""
    taken = [
        F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1)), bit * len(places) + len(places) - 1 - n)
        for n, place in enumerate(places)
        for bit in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), taken)
