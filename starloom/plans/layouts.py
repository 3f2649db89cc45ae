"""Loads the order star plain and laid out, and times the same reports on both."""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable, Iterable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.wide import percent_improvement
from starloom.plans.star_queries import Report
from starloom.schemas import TableSpec
from starloom.sinks import layout, tables
from starloom.sources.files import read_delimited


def store(rows: DataFrame, name: str, spec: TableSpec) -> None:
    """Writes a table as its spec lays it out: bucketed, sorted, or as it comes."""
    if spec.bucket_by:
        layout.write_bucketed(rows, name, spec.bucket_by[0], spec.buckets, spec.sort_by)
    elif spec.sort_by:
        layout.write_sorted(rows, name, *spec.sort_by)
    else:
        tables.create_table_as(rows, name)


def load_tables(
    spark: SparkSession, folder: str, specs: Iterable[TableSpec], database: str, sep: str = "|"
) -> DataFrame:
    """Loads the delimited files of each table, and tells how many seconds each took."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    seconds = []
    for spec in specs:
        start = time.perf_counter()
        rows = read_delimited(spark, f"{folder}/{spec.name}", spec.schema, sep, header_rows=0)
        store(rows, tables.qualified(spec.name, database), spec)
        seconds.append((spec.name, time.perf_counter() - start))
    return spark.createDataFrame(seconds, f"table string, seconds_{database} double")


def seconds_of(query: Callable[[], DataFrame], runs: int = 3) -> float:
    """Median seconds to build a query and work out all its rows, after a run that does not count;
    with 0 runs, the seconds of that run."""
    measured = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        query().write.format("noop").mode("overwrite").save()
        measured.append(time.perf_counter() - start)
    return statistics.median(measured[1:] or measured)


def compare_query_times(
    spark: SparkSession,
    reports: Mapping[str, Report],
    plain: Mapping[str, DataFrame],
    laid_out: Mapping[str, DataFrame],
    runs: int = 3,
) -> DataFrame:
    """Seconds of each report on the tables of both layouts, and the improvement in percent."""

    def timed(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
        rows = [(q, seconds_of(partial(report, tables), runs)) for q, report in reports.items()]
        return spark.createDataFrame(rows, f"query string, {name} double")

    both = timed(plain, "plain").join(timed(laid_out, "laid_out"), "query")
    improvement = percent_improvement(F.col("plain"), F.col("laid_out"))
    return both.withColumn("improvement", improvement)
