"""Structs, maps, arrays of annotations, and the word counts built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.text import words
from starloom.operators.aggregates import count_by


def struct_fields(rows: DataFrame, *paths: str) -> DataFrame:
    """Fields inside structs as columns, named after the last part of the path."""
    return rows.select(*[F.col(path).alias(path.rsplit(".", 1)[-1]) for path in paths])


def map_values(rows: DataFrame, column: str, keys: Sequence[str], *keep: str) -> DataFrame:
    """Map entries as columns; a key that is missing gives null."""
    return rows.select(*keep, *[F.col(column)[key].alias(key) for key in keys])


def word_count(rows: DataFrame, text: str, limit: int | None = None) -> DataFrame:
    """How often each word occurs, most frequent first."""
    counted = count_by(rows.select(F.explode(words(F.col(text))).alias("word")), "word")
    return counted.limit(limit) if limit else counted


def tagged_words(
    rows: DataFrame, annotations: str, tags: Sequence[str], metadata: str = "word"
) -> DataFrame:
    """One row per annotation with one of the tags: the tag and the tagged word.

    Annotations with other tags are dropped inside the array, before they become rows.
    """
    wanted = F.filter(F.col(annotations), lambda one: one["result"].isin(*tags))
    return rows.select(F.explode(wanted).alias("pos")).select(
        F.col("pos.metadata")[metadata].alias("word"), F.col("pos.result").alias("tag")
    )


def tag_filter_count(
    rows: DataFrame, annotations: str, tags: Sequence[str], name: str = "count"
) -> DataFrame:
    """How often each word with one of the tags occurs, most frequent first."""
    return count_by(tagged_words(rows, annotations, tags), "word", name=name)
