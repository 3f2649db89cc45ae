"""JSON, delimited and text files. Schemas are given; inference has to be asked for."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
JSON_FILES = "*.json*"
NULL_TEXT = "\\N"  # a null in delimited text that tells it from an empty one


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    recursive: bool = True,
    mode: str = "FAILFAST",
    glob: str = JSON_FILES,
) -> DataFrame:
    """Line-JSON under a folder, a glob, or several of them, as one frame.

    Files in subfolders are included if their names fit `glob`. A line that does not fit the
    schema stops the read; with `mode` PERMISSIVE its fields are null, and `read_json_checked`
    keeps such lines apart.
    """
    reader = spark.read.schema(schema).option("mode", mode)
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return reader.json(path if isinstance(path, str) else list(path))


def read_json_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """Line-JSON with the schema found by a pass over the data. For exploring, not for jobs."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("samplingRatio", sampling_ratio)
        .json(path)
    )


def read_json_checked(
    spark: SparkSession, path: str, schema: T.StructType, glob: str = JSON_FILES
) -> tuple[DataFrame, DataFrame]:
    """Lines that fit the schema, and the others as (line, file)."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        "value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .text(path)
        .where(F.trim("value") != "")
        .select("value", F.col("_metadata.file_path").alias("file"), parsed.alias("row"))
    )
    bad = F.col(f"row.{CORRUPT}").isNotNull()
    good = lines.where(~bad).select(*[F.col(f"row.{name}") for name in schema.names])
    return good, lines.where(bad).select(F.col("value").alias("line"), "file")


def paths_of(spark: SparkSession, path: str, columns: Sequence[str]) -> list[str]:
    """The JSON paths of a mapping file, which lists one per column in order."""
    text = spark.read.text(path, wholetext=True).where("value <> ''").first().value
    paths = json.loads(text)["jsonpaths"]
    if len(paths) != len(columns):
        raise ValueError(f"{path} has {len(paths)} paths for {len(columns)} columns")
    return paths


def read_json_by_paths(
    spark: SparkSession, path: str, paths_file: str, schema: T.StructType, glob: str = JSON_FILES
) -> tuple[DataFrame, DataFrame]:
    """Line-JSON to the schema's columns by a file of JSON paths, and lines that are no JSON as
    (line, file).

    Lines need not be alike: each is parsed once, as a variant, and every column takes what lies at
    its path, cast to its type. A path that a line does not have, or a value that does not fit the
    type, is null. Nothing is inferred, so no pass over the files comes before.
    """
    paths = paths_of(spark, paths_file, schema.names)
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .text(path)
        .where(F.trim("value") != "")
        # out of a generator, below which no filter on it can be copied: a line is parsed once
        .select(
            F.col("value").alias("line"),
            F.col("_metadata.file_path").alias("file"),
            F.explode_outer(F.array(F.try_parse_json("value"))).alias("row"),
        )
    )
    columns = [
        F.try_variant_get("row", at, field.dataType.simpleString()).alias(field.name)
        for at, field in zip(paths, schema.fields)
    ]
    bad = F.col("row").isNull()
    return lines.where(~bad).select(*columns), lines.where(bad).select("line", "file")


def mapping_from_paths_file(
    spark: SparkSession, path: str, columns: Sequence[str]
) -> dict[str, str]:
    """Column to field path, from a mapping file that lists one JSON path per column in order.

    Understands `$['a']['b']` and `$.a.b`.
    """
    paths = paths_of(spark, path, columns)
    steps = re.compile(r"\['([^']+)'\]|\.([^.\[]+)")
    return {
        column: ".".join(f"`{quoted or plain}`" for quoted, plain in steps.findall(entry))
        for column, entry in zip(columns, paths)
    }


def by_name(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, cast to its types; a column the rows do not have is null."""
    present = {name.lower(): name for name in rows.columns}
    return rows.select(
        *[
            (F.col(f"`{present[f.name.lower()]}`") if f.name.lower() in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def by_mapping(rows: DataFrame, mapping: Mapping[str, str], schema: T.StructType) -> DataFrame:
    """The schema's columns, each from the field path that the mapping names for it."""
    return rows.select(
        *[F.col(mapping[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def run_date_path(base: str, run_date: date | None = None) -> str:
    """The folder of a run's month, `base/yyyy/MM`; the whole base without a date."""
    return f"{base.rstrip('/')}/{run_date:%Y/%m}" if run_date else base


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    sep: str = ",",
    header_rows: int = 1,
    infer: bool = False,
    spread: int | None = None,
    mode: str = "FAILFAST",
    verbatim: bool = False,
    **key_values,
) -> DataFrame:
    """Delimited text, gzip included: a file, a glob or a folder.

    Without a schema every column is text, or inferred if asked for. `key_values` fill the
    placeholders of a path such as `trips/{ds}.csv`. A gzip file is one task however large
    it is; `spread` deals its rows over that many tasks for the work that follows, and many
    smaller files need none of that. `header_rows` lines at the head of every file are skipped;
    more than one needs a schema. A line that does not fit the schema stops the read, unless
    `mode` is PERMISSIVE; `read_delimited_checked` keeps such lines apart. `verbatim` reads what
    was written so: a null is `NULL_TEXT`, an empty text is one.
    """
    path = path.format(**key_values) if key_values else path
    if schema is not None and infer:
        raise ValueError("give a schema or infer one, not both")
    if header_rows > 1:
        if schema is None:
            raise ValueError("a file with several header rows needs a schema")
        parsed = F.from_csv("value", _ddl(schema), {"sep": sep, "mode": mode}).alias("row")
        rows = _after_header(spark, path, header_rows).select(parsed).select("row.*")
        return rows.repartition(spread) if spread else rows
    reader = (
        spark.read.option("sep", sep)
        .option("header", header_rows == 1)
        .option("inferSchema", infer)
        .option("mode", mode)
    )
    if verbatim:
        reader = reader.option("nullValue", NULL_TEXT)
    if schema is not None:
        # With a schema the header is only skipped: columns go by position.
        reader = reader.schema(schema).option("enforceSchema", True)
    rows = reader.csv(path)
    return rows.repartition(spread) if spread else rows


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _after_header(spark: SparkSession, path: str, header_rows: int) -> DataFrame:
    """Lines (value, file) behind the head of each file. A file's first lines are numbered in a row
    by the task that reads its start, so the number of the first tells which to skip."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    heads = lines.where("block = 0").groupBy(F.col("file").alias("of")).agg(F.min("line").alias("head"))
    behind = (F.col("block") > 0) | (F.col("line") >= F.col("head") + header_rows)
    return lines.join(heads, F.col("file") == F.col("of")).where(behind & (F.trim("value") != "")).select("value", "file")


def read_delimited_checked(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header_rows: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Lines that fit the schema, and the others as (line, file)."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_csv("value", _ddl(with_corrupt), options).alias("row")
    lines = _after_header(spark, path, header_rows).select("value", "file", parsed)
    bad = F.col(f"row.{CORRUPT}").isNotNull()
    good = lines.where(~bad).select(*[F.col(f"row.{name}") for name in schema.names])
    return good, lines.where(bad).select(F.col("value").alias("line"), "file")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines, gzip included, in a column `value`."""
    return spark.read.text(path)
