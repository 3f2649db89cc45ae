"""Stored tables, local rows and named views."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Tables(Mapping):
    """The parquet tables of a folder by name, each read when first asked for.

    The schemas are given, so that no files are opened to find them.
    """

    def __init__(self, spark: SparkSession, folder: str, schemas: Mapping[str, T.StructType]):
        self.spark = spark
        self._folder, self._schemas = folder.rstrip("/"), schemas
        self._read: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._read:
            reader = self.spark.read.schema(self._schemas[name])
            self._read[name] = reader.parquet(f"{self._folder}/{name}.parquet")
        return self._read[name]

    def __iter__(self):
        return iter(self._schemas)

    def __len__(self) -> int:
        return len(self._schemas)


def from_local(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """A frame from rows held by the driver: a short list, a lookup, a test input."""
    return spark.createDataFrame(list(rows), schema)


def named_views(tables: Mapping[str, DataFrame]) -> None:
    """Makes each frame known to SQL under its name, for this session."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(name)
