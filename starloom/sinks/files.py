"""Files written to a path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from starloom.sources.files import NULL_TEXT


def prepared(rows: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrame:
    """The rows as they should reach the writing tasks."""
    if partition_by:
        # Brings the rows of a folder together so that it gets few files. AQE then splits a
        # folder that is too large for one task and merges those that are small.
        rows = rows.hint("rebalance", *partition_by)
    if sort_by:
        rows = rows.sortWithinPartitions(*partition_by, *sort_by)
    return rows


def write_parquet(
    rows: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Parquet files, in one folder per value of the partition columns.

    Sorted files have narrow value ranges per row group, which later filters skip by.
    """
    writer = prepared(rows, partition_by, sort_by).write.mode(mode)
    if partition_by:
        # A static overwrite: folders of earlier runs that this run has no rows for go too.
        writer = writer.option("partitionOverwriteMode", "static").partitionBy(*partition_by)
    writer.parquet(path)


def replace_partitions(
    rows: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()
) -> None:
    """Replaces only the folders that `rows` has values for, once all tasks are done.

    `rows` may be read from the same path.
    """
    prepared(rows, partition_by, sort_by).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partition_by).parquet(path)


def write_delimited(
    rows: DataFrame,
    path: str,
    sep: str = ",",
    header: bool = True,
    single_file: bool = False,
    compression: str | None = None,
    verbatim: bool = False,
) -> None:
    """Delimited text with a header.

    `single_file` sends all rows through one writing task: for small exports only. The work
    before the write stays spread. `verbatim` keeps blanks around a text and tells an empty text
    from a null, which is written as `NULL_TEXT`.
    """
    writer = (rows.repartition(1) if single_file else rows).write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if verbatim:
        blanks = dict.fromkeys(("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"), False)
        writer = writer.options(nullValue=NULL_TEXT, **blanks)
    writer.option("sep", sep).option("header", header).csv(path)
