"""One query per operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    decontamination, divergence, minhash, mixing, packing, pages, periodic, preference, repeats, sharding, spans,
    variants, weaklabel,
)
from starloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_preference_pairs(spark: SparkSession, folder: str) -> DataFrame:
    pairs = preference.preference_pairs(*preference.neighbour_replies(table(spark, folder, "conversations")))
    return pairs.withColumns({c: preference.spans_text(F.col(c)) for c in ("chosen_spans", "rejected_spans")})


def op2_systematic_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents")).drop("source")


def op3_divergence_rules(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.judged(table(spark, folder, "documents"))


def op4_weak_label_quality(spark: SparkSession, folder: str) -> DataFrame:
    return weaklabel.classified(table(spark, folder, "documents"), reject_abuse=True)


def op5_extendible_shards(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    rows = sharding.sharded(documents.select("doc_id", "text"))
    return rows.select("doc_id", sharding.text_bytes().alias("n_bytes"), *sharding.COLUMNS)


def op6_simhash_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.decontaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_run_length_spans(spark: SparkSession, folder: str) -> DataFrame:
    return spans.without_earlier(table(spark, folder, "documents")).drop("kept")


def op8_tree_model_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extracted(table(spark, folder, "pages"))


def op9_count_min_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.without_repeats(table(spark, folder, "documents")).drop("kept_text")


def op10_minmax_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    documents = periodic.with_repeated_tails(table(spark, folder, "documents"))
    return periodic.digests(periodic.periodic_runs(documents))


def op12_large_item_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pieces(table(spark, folder, "documents"))
    return packing.placed(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.grouped(variants.vocabulary(table(spark, folder, "documents"), slip_one_in=97))


QUERIES: dict[str, Query] = {
    "op1_preference_pairs": op1_preference_pairs,
    "op2_systematic_mix": op2_systematic_mix,
    "op3_divergence_rules": op3_divergence_rules,
    "op4_weak_label_quality": op4_weak_label_quality,
    "op5_extendible_shards": op5_extendible_shards,
    "op6_simhash_decontamination": op6_simhash_decontamination,
    "op7_run_length_spans": op7_run_length_spans,
    "op8_tree_model_text": op8_tree_model_text,
    "op9_count_min_repeats": op9_count_min_repeats,
    "op10_minmax_near_dedup": op10_minmax_near_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_large_item_packing": op12_large_item_packing,
    "op13_spelling_variants": op13_spelling_variants,
}
