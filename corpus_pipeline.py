"""The stages that turn `documents` into shards ready for training."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starloom.llm import decontamination, minhash, mixing, sharding, weaklabel  # noqa: E402
from starloom.llm.common import table, written  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Keys of rows to be left out that are broadcast, 32 MB; more are joined by a shuffle.
MOST_BROADCAST = 4_000_000


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose doc_id and text do not have one of the keys (row_key)."""
    keys = written(keys.distinct(), "left_out")
    if keys.count() <= MOST_BROADCAST:
        keys = F.broadcast(keys)
    return docs.join(keys, F.xxhash64(docs.doc_id, docs.text) == keys.row_key, "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go."""
    return weaklabel.accepted(docs)


def quality_without_abuse(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects for their writing or as abusive go."""
    return weaklabel.accepted(docs, reject_abuse=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest doc_id stays.

    Rows that repeat this document in doc_id are of one document and all stay, as do rows
    without a doc_id.
    """
    left_out = minhash.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    left_out = written(left_out, "left_out")
    if left_out.count() <= MOST_BROADCAST:
        left_out = F.broadcast(left_out)
    return docs.join(left_out, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window like a benchmark item go."""
    return _without(docs, decontamination.leaks(docs, table(spark, sf_dir, "benchmark")).select("row_key"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.emitted(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, and the shard of each row."""
    return sharding.sharded(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_without_abuse),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

#: The classifier and the signatures have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
