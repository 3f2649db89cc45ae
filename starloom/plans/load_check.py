"""Load a delimited file into a table, check it has rows, summarise it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.operators import aggregates, quality
from starloom.schemas import TableSpec
from starloom.sinks import tables
from starloom.sources.files import read_delimited


def load_and_check(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    database: str | None = None,
    sep: str = ",",
    header_rows: int = 1,
    **key_values,
) -> DataFrame:
    """Creates the table if it is missing, clears and loads it, and raises if it has no rows."""
    name = tables.qualified(spec.name, database)
    tables.create_tables(spark, [spec], database)
    loaded = read_delimited(spark, path, spec.schema, sep, header_rows, **key_values)
    tables.load_table(loaded, name)
    return quality.require_rows(spark.table(name), name)


def summarise(spark: SparkSession, origin: str, destination: str, fact: str, by: str) -> None:
    """max, min and average of a column per group, as a table of its own."""
    tables.create_table_as(aggregates.fact_summary(spark.table(origin), fact, by), destination)
