"""The stages, one after the other, against their operators and brute force."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from starloom.llm import decontamination, weaklabel
from llm.test_documents import expected_groups

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = corpus_pipeline.table(spark, FOLDER, "documents")
    given = docs.collect()
    accepted = corpus_pipeline.quality(spark, docs, FOLDER)
    assert accepted.columns == docs.columns
    kept = {r.doc_id for r in weaklabel.classified(docs).collect() if r.kept}
    rows = [tuple(r) for r in given if r.doc_id in kept]
    assert sorted(map(tuple, accepted.collect())) == sorted(rows)

    deduped = corpus_pipeline.near_dedup(spark, accepted, FOLDER)
    stay = {g[0] for g in expected_groups(rows) if g[3]}
    rows = [r for r in rows if r[0] in stay]
    assert deduped.columns == docs.columns and sorted(map(tuple, deduped.collect())) == sorted(rows)

    clean = corpus_pipeline.decontaminate(spark, deduped, FOLDER)
    benchmark = corpus_pipeline.table(spark, FOLDER, "benchmark")
    leaked = {r.doc_id for r in decontamination.decontaminated(deduped, benchmark).collect() if not r.kept}
    rows = [r for r in rows if r[0] not in leaked]
    assert leaked and sorted(map(tuple, clean.collect())) == sorted(rows)

    mixed = corpus_pipeline.mix(spark, clean, FOLDER)
    out = Counter(map(tuple, mixed.collect()))
    assert mixed.columns == docs.columns and set(out) <= set(rows) and max(out.values()) <= 3

    sharded = corpus_pipeline.shard(spark, mixed, FOLDER)
    assert Counter(tuple(r)[:5] for r in sharded.collect()) == out


def test_stages_with_nulls_and_nothing(spark):
    docs = corpus_pipeline.table(spark, FOLDER, "documents").limit(5)
    odd = docs.selectExpr("cast(null as bigint) doc_id", "text", "cast(null as string) lang", "cast(null as string) source", "n_chars")
    for frame in (docs.unionByName(odd), docs.where("false")):
        out = frame
        for name, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.written(stage(spark, out, FOLDER), name)
        assert set(docs.columns) <= set(out.columns) and out.count() >= 0


def test_run(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.count() > 50 and {"shard_id", "shard_size"} <= set(got.columns)
