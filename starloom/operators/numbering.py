"""Row numbers without gaps that no single task hands out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLACE_BITS = 33  # of monotonically_increasing_id: the task is above, the place in the task below


def numbered(rows: DataFrame, name: str, order: Sequence[Column | str], folder: str, after: int = 0) -> DataFrame:
    """Adds a bigint column that numbers the rows in the given order: after + 1, after + 2, ...

    Tasks take ranges of the order and write their rows with their places to `folder`. The
    numbers of the rows in each task, one a task, are added up, and a row's number is what
    comes before its task plus its place. Rows of equal order are told apart by a hash of the
    row, so that many of them spread over tasks, too. A total order gives the same numbers however
    often the work is repeated; rows that are equal in all columns share theirs in any order.
    """
    hashed = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    by = [*order, F.xxhash64(*hashed)]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = ranged.withColumn("_place", F.monotonically_increasing_id())
    placed.write.mode("overwrite").parquet(folder)
    stored = rows.sparkSession.read.schema(placed.schema).parquet(folder)
    lane = F.shiftright("_place", _PLACE_BITS)
    counts = stored.groupBy(lane.alias("_lane")).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_lane", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    number = (F.lit(after + 1) + F.col("_before") + place).cast("bigint").alias(name)
    return stored.join(before, lane == F.col("_lane")).select(number, *rows.columns)
