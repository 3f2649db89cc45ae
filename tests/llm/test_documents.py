"""Near duplicates, mixing, rules, classifier and shards against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import divergence, minhash, mixing, sharding, weaklabel
from starloom.llm.queries import QUERIES
from llm.conftest import frame, sentence, words_of


def shingles(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words_of(text)]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1)))


def expected_groups(rows):
    sets = [(r[0], shingles(r[1])) for r in rows]
    root = {d: d for d, _ in sets if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    out = []
    for d, s in sets:
        component = None if d is None else find(d)
        out.append((d, len(s), component, d is None or component == d))
    return sorted(out, key=repr)


def test_near_duplicates(documents, rows):
    got = minhash.near_duplicates(documents).collect()
    assert sorted(map(tuple, got), key=repr) == expected_groups(rows)


def test_groups_that_no_single_document_links(spark):
    """Chains of versions, each like its neighbours only, in shuffled order of ids."""
    rng = random.Random(8)
    rows, ids = [], list(range(150))
    rng.shuffle(ids)
    for chain in range(5):
        words = sentence(rng, 120).split()
        for _ in range(30):
            words = list(words)
            words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
            rows.append((ids.pop(), " ".join(words), "en", "s"))
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == expected_groups(rows)


def test_small_sets_lose_no_link(spark):
    """Texts of four to seven shingles next to the same without their last."""
    rng = random.Random(11)
    rows = []
    for k in range(0, 3000, 2):
        words = [f"w{rng.randrange(10**9)}" for _ in range(rng.randrange(8, 12))]
        rows += [(k, " ".join(words), "en", "s"), (k + 1, " ".join(words[:-1]), "en", "s")]
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert all(r.component_id == r.doc_id - r.doc_id % 2 for r in got)


def test_many_texts_of_one_template(spark):
    """5,000 texts that share three fifths of their shingles, and some that are alike enough."""
    rng = random.Random(12)
    template = sentence(rng, 160)
    tails = [" ".join(f"t{k}x{n}" for n in range(54)) for k in range(5000)]
    rows = [(k, f"{template} {tail}", "en", "s") for k, tail in enumerate(tails)]
    near = {7: 4003, 2500: 4998, 3100: 3101}
    for a, b in near.items():
        rows[b] = (b, f"{template} {tails[a].rsplit(' ', 1)[0]} other", "en", "s")
    shared, private = 156, 54
    assert 100 * shared >= 58 * (shared + 2 * private) and 100 * shared < 75 * (shared + 2 * private)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == {k: k for k in range(5000)} | {b: a for a, b in near.items()}


def test_given_documents_against_an_exact_join(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    got = QUERIES["op10_minmax_near_dedup"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, got), key=repr) == expected_groups(rows)


def test_min_max_estimate_is_near():
    rng = np.random.default_rng(1)
    shared, own = rng.integers(0, 2**63, 750).astype(np.uint64), rng.integers(0, 2**63, 250).astype(np.uint64)
    a, b = minhash.signatures([np.unique(np.concatenate((shared, own[:125]))), np.unique(np.concatenate((shared, own[125:])))])
    assert abs((a == b).mean() - 0.75) < 0.15


def expected_mix(rows):
    sizes = [(r[0], r[3], len(words_of(r[1]))) for r in rows]
    source_size = Counter()
    for _, source, n in sizes:
        source_size[source] += n
    names = sorted((s for s in source_size if s is not None)) + [None] * (None in source_size)
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    total, target, free = sum(source_size.values()), {}, set(names)
    while free:
        left = total - sum(target.values())
        shares = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if shares[s] > 3 * source_size[s]}
        if not over:
            target.update(shares)
            break
        target.update({s: 3 * source_size[s] for s in over})
        free -= over
    return source_size, target


def test_mix(documents, rows):
    source_size, target = expected_mix(rows)
    got = mixing.mixed(documents).collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((r[0], r[3], len(words_of(r[1]))) for r in rows)
    taken = Counter()
    for r in got:
        assert r.source_size == source_size[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    longest = Counter()
    for r in got:
        longest[r.source] = max(longest[r.source], r["size"])
    for source, wanted in target.items():
        assert abs(taken[source] - wanted) <= 3 * longest[source]
    copies = Counter({s: 0 for s in target})
    for r in got:
        copies[r.source] += r.copies
    docs = Counter(r[3] for r in rows)
    for source, wanted in target.items():
        if source_size[source]:
            assert abs(copies[source] - docs[source] * wanted / source_size[source]) <= 1
    assert sorted(map(tuple, mixing.mixed(documents).collect()), key=repr) == sorted(map(tuple, got), key=repr)


def test_mix_emits_what_it_plans(documents):
    plan = Counter()
    for r in mixing.mixed(documents).collect():
        plan[r.doc_id, r.source] += r.copies
    out = mixing.emitted(documents)
    assert out.columns == documents.columns
    assert Counter((r.doc_id, r.source) for r in out.collect()) == +plan


def expected_counts(text):
    words = words_of(text)
    found = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if found[tuple(words[k : k + 3])] > 1 for j in range(3)}
    seen, doubled = set(), 0
    for line in (text or "").split("\n"):
        if words_of(line):
            doubled += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), doubled, len(covered)


def test_rules(documents, rows, spark):
    more = [(1000, "a b\n\na b\n a b\nc|d # <x>\n", "en", "s"), (1001, "é ü\x0b& " * 70, "en", "s")]
    got = divergence.judged(documents.unionByName(frame(spark, more))).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in got) == Counter((r[0], *expected_counts(r[1])) for r in rows + more)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
        assert r.n_words >= 80 or r.word_distance is None


def test_divergence_rejects_other_writing(spark):
    rng = random.Random(2)
    rows = [(k, sentence(rng, 120), "en", "s") for k in range(60)]
    rows.append((60, " ".join(f"|{w}###" for w in sentence(rng, 120).split()), "en", "s"))
    rows.append((61, " ".join(f"Q{k}!!" for k in range(120)), "en", "s"))
    kept = {r.doc_id: r.kept for r in divergence.judged(frame(spark, rows)).collect()}
    assert all(kept[k] for k in range(60)) and not kept[60] and not kept[61]


def test_jensen_shannon_distance():
    got = divergence.distance(np.array([[1, 1], [1, 0], [0, 1]]), np.array([1, 0]))
    assert got[1] == 0 and got[2] == 1
    p, m = np.array([0.5, 0.5]), np.array([0.75, 0.25])
    assert got[0] == pytest.approx(math.sqrt(((p * np.log2(p / m)).sum() + np.log2(1 / 0.75)) / 2))


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = weaklabel.classified(spark.read.parquet(f"{folder}/documents.parquet")).join(labels, "doc_id")
    good = got.agg(F.avg(F.expr("cast(kept = (quality = 1) as int)")), F.avg(F.expr("case when quality = 1 then cast(kept as int) end"))).first()
    assert good[0] > 0.97 and good[1] > 0.99


def test_classifier_on_odd_rows(documents, rows):
    got = weaklabel.classified(documents).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    without = {r[0] for r in rows if not words_of(r[1])}
    assert all(r.score == 0 and not r.kept for r in got if r.doc_id in without and r.doc_id is not None)
    kept = Counter(r.doc_id for r in got if r.kept)
    assert Counter(r.doc_id for r in weaklabel.accepted(documents).collect()) == kept


def test_sample_takes_one_row_an_id(spark, monkeypatch):
    held = []
    fit = weaklabel.fit_scorer
    monkeypatch.setattr(weaklabel, "fit_scorer", lambda *found: held.append(len(found[3])) or fit(*found))
    rows = [(k % 5, f"The river rose in the night, and {k} of the fields were gone.", "en", "s") for k in range(800)]
    weaklabel.fitted(frame(spark, rows), trained_on=5)
    assert held == [5]


def test_abuse_of_good_writing_is_rejected(spark):
    story = "The river rose in the night, and by morning the lower fields were gone. Nobody in the valley had seen so much rain. "
    texts = [
        story,
        story + "You are an IDIOT, a pathetic clown!",
        story + "Ihr seid alle ABSCHAUM, du Trottel.",
        story + "Quel CRÉTIN, cet abruti.",
        story + "Eres un imbécil, ¡gilipollas!",
        story * 20 + "One man called another an idiot.",
        story * 2 + "A clown came, and the clown was a good clown.",
        story + "Con una casa. The con was long; die Frau kam.",
    ]
    rows = [(k, t, None, "s") for k, t in enumerate(texts * 3)]
    docs = frame(spark, rows)
    got = weaklabel.classified(docs, least_score=0.0, reject_abuse=True).collect()
    assert {r.doc_id % 8 for r in got if not r.kept} == {1, 2, 3, 4} == {r.doc_id % 8 for r in got if r.votes[-1] == "b"}
    accepted = weaklabel.accepted(docs, least_score=0.0, reject_abuse=True).collect()
    assert Counter(r.doc_id for r in accepted) == Counter(r.doc_id for r in got if r.kept)


def test_toxic_labels_and_clean_ones(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op4_weak_label_quality"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    english = got.join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").where("lang = 'en'")
    toxic, clean = (english.where(w).agg(F.avg(F.expr("cast(kept as int)"))).first()[0] for w in ("toxic = 1", "toxic = 0 and quality = 1"))
    assert toxic < 0.15 and clean > 0.99


def test_expectation_maximisation_finds_the_bad_labeller():
    rng = np.random.default_rng(4)
    truth = rng.random(4000) < 0.7
    rates = (0.9, 0.85, 0.8, 0.55)
    votes = np.stack([np.where(rng.random(4000) < r, truth, ~truth) for r in rates], axis=1)
    patterns, counts = np.unique(np.where(votes, weaklabel.GOOD, weaklabel.BAD), axis=0, return_counts=True)
    posterior, found = weaklabel.fit_votes(patterns, counts.astype(float))
    assert np.allclose(found[:, 0, weaklabel.GOOD], rates, atol=0.06)


@pytest.mark.parametrize("limit, most_broadcast", ((500, 10**6), (500, 0), (4000, 10**6), (10**7, 10**6)))
def test_shards(documents, rows, limit, most_broadcast):
    found = sharding.sharded(documents, limit, most_broadcast)
    assert found.columns == [c for c in documents.columns if c not in sharding.COLUMNS] + list(sharding.COLUMNS)
    got = found.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    size, ids, depth = Counter(), {}, {}
    for r in got:
        size[r.shard_id] += len((r.text or "").encode())
        ids.setdefault(r.shard_id, set()).add(r.doc_id)
        depth[r.shard_id] = r.shard_depth
    for r in got:
        assert r.shard_size == size[r.shard_id] and r.shard_depth == len(r.shard_id)
        assert r.shard_size <= limit or len(ids[r.shard_id]) == 1
    for shard in size:  # only buckets over the limit are split
        if shard:
            assert sum(n for s, n in size.items() if s.startswith(shard[:-1])) > limit


def test_empty_tables(nothing):
    for found in (
        minhash.near_duplicates(nothing), mixing.mixed(nothing), mixing.emitted(nothing), divergence.judged(nothing),
        weaklabel.classified(nothing), weaklabel.accepted(nothing), sharding.sharded(nothing),
    ):
        assert found.collect() == []
