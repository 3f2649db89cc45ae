"""Periodic runs, packing and spelling variants against brute force, on every odd case."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.conftest import frame, words_of
from starloom.llm import kdtree, packing, periodic, variants
from starloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def tailed(doc, words):
    """The words of a document of which every tenth is made to repeat its tail."""
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if doc is None or h % 10 or not n:
        return words
    g = h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected_runs(words, least=6, exponent=4):
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        start = 0
        while start + q < n:
            end = start + q
            while end < n and words[end] == words[end - q]:
                end += 1
            # a stretch that a divisor of q repeats in has been found with that period
            if end - start >= max(least, exponent * q) and not any((start, end) == (s, s + m) and q % p == 0 for (s, m), p in found.items()):
                found[start, end - start] = q
            start = max(end - q + 1, start + 1)
    return sorted((s, m, p) for (s, m), p in found.items())


def collapsed(words, runs):
    gone = {k for s, m, p in runs for k in range(s + p, s + m)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def repetitive(seed=4):
    """Rows with many runs: few words, tails that repeat, runs inside runs, one very long run."""
    rng, rows = random.Random(seed), []
    for doc in range(220):
        words = [f"w{rng.randrange(rng.choice((1, 2, 3, 40)))}" for _ in range(rng.randrange(90))]
        if doc % 3 == 0 and words:
            part = words[: rng.randrange(1, 9)]
            words += part * rng.randrange(3, 8) + words[:7]
        rows.append((doc, rng.choice((" ", "\n", " \t ")).join(words) + rng.choice(("", " ")), "en", "s"))
    rows.append((220, "x " * 20_000 + "y", "en", "s"))
    return rows + [(221, None, None, None), (222, "", "en", "s"), (223, " \n", "en", "s"), (None, "a b " * 9, "en", "s"), rows[5]]


def test_periodic_runs(spark, documents, rows):
    for docs, given in ((documents, rows), (frame(spark, repetitive()), repetitive())):
        got = periodic.periodic_runs(docs).collect()
        want = []
        for row in given:
            words = words_of(row[1])
            runs = [(0, 20_000, 1)] if row[0] == 220 and len(words) > 20_000 else expected_runs(words)
            want.append((row[0], len(words), runs, collapsed(words, runs)))
        assert sorted(((r[0], r[1], list(map(tuple, r[2])), r[3]) for r in got), key=repr) == sorted(want, key=repr)


def test_runs_of_other_lengths(spark):
    rows = repetitive(9)[:150]
    for least, exponent in ((2, 2), (4, 3), (9, 2)):
        got = {r.doc_id: list(map(tuple, r.runs)) for r in periodic.periodic_runs(frame(spark, rows), least, exponent).collect()}
        assert got == {r[0]: expected_runs(words_of(r[1]), least, exponent) for r in rows}
    with pytest.raises(ValueError):
        periodic.periodic_runs(frame(spark, rows), 6, 1)


def test_periodic_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, FOLDER).collect()}
    assert len(got) == len(rows)
    for doc, text in rows:
        words = tailed(doc, words_of(text))
        runs = expected_runs(words)
        best = min(((-m, s, p) for s, m, p in runs), default=None)
        lines = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
        r = got[doc]
        assert (r.n_runs, r.runs_sha256) == (len(runs), hashlib.sha256(lines.encode()).hexdigest())
        assert (r.start, r.length, r.period) == ((best[1], -best[0], best[2]) if best else (None,) * 3)
        assert r.exponent_milli == (1000 * -best[0] // best[2] if best else None)
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()


def test_places_stay_in_order():
    rng = random.Random(2)
    numbers = rng.sample(range(10**6), 5000)
    places = periodic.Places(numbers[0])
    for k, number in enumerate(numbers[1:], 1):
        before, after = places.add(number)
        if k % 100 == 0:
            others = numbers[:k]
            assert before == max((x for x in others if x < number), default=-1)
            assert after == min((x for x in others if x > number), default=-1)
    assert list(places) == sorted(numbers) and places.size == 5000


def filled(rows, capacity):
    """Number of sequences, after looking at every one: no gaps, nothing over the capacity."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing(spark, documents, rows):
    exact = Tokenizer.from_file(packing.VOCABULARY)
    cut = packing.pieces(documents, 256)
    got = packing.placed(cut, 256).collect()
    want = []
    for row in rows:
        ids = exact.encode(row[1] or "", add_special_tokens=False).ids + [0]
        first = len(ids) if len(ids) <= 256 else len(ids) % 256 or 256
        starts = [0, *range(first, len(ids), 256)]
        want += [(row[0], k, s, e - s, ids[s:e]) for k, (s, e) in enumerate(zip(starts, [*starts[1:], len(ids)]))]
    assert sorted(((*r[:4], np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=repr) == sorted(want, key=repr)
    assert filled(got, 256) <= 1.05 * sum(r.length for r in got) / 256 + 1  # few pieces, a third of them large
    ids = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.sequences(packing.placed(cut, 256)).collect()}
    assert sum(map(len, ids.values())) == sum(r.length for r in got) and max(map(len, ids.values())) <= 256


def test_packing_query(spark):
    exact = Tokenizer.from_file(packing.VOCABULARY)
    got = QUERIES["op12_large_item_packing"](spark, FOLDER).collect()
    texts = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    ids = {doc: exact.encode(text or "", add_special_tokens=False).ids + [0] for doc, text in texts.items()}
    assert sum(r.length for r in got) == sum(map(len, ids.values()))
    for r in got:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(part)
    assert filled(got, 2048) <= 1.01 * sum(r.length for r in got) / 2048 + 1


def test_ids_of_odd_texts():
    encoder, exact = packing.Encoder(), Tokenizer.from_file(packing.VOCABULARY)
    odd = ["<|endoftext|> a<|endoftext|>", "日本語 текст", " x  y", "\U0001f600 ok", "a  b\n\n c", " " * 5000, "ab" * 4000]
    odd += [f(chr(c)) for c in range(1, ord(packing.LAST_ALIKE) + 1) for f in ("a{0}b".format, " {0}{0} 1".format, "\n{0}  x".format)]
    for text in odd:
        assert encoder.ids(text).tolist() == exact.encode(text, add_special_tokens=False).ids + [0]
    long = " ".join(f"word{k} and  so\n" for k in range(9000)) + "z" * 3000 + " end"
    assert "".join(packing.slices(long, 500)) == long and len(list(packing.slices(long, 500))) > 50
    sliced = [i for part in packing.slices(long, 500) for i in exact.encode(part, add_special_tokens=False).ids]
    assert sliced == exact.encode(long, add_special_tokens=False).ids


def best_possible(lengths, capacity):
    """The least number of bins, by trying everything."""
    best = [len(lengths)]

    def put(k, gaps):
        if len(gaps) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(gaps)
            return
        for g in {g for g in gaps if g >= lengths[k]}:
            rest = list(gaps)
            rest[rest.index(g)] -= lengths[k]
            put(k + 1, rest)
        put(k + 1, [*gaps, capacity - lengths[k]])

    put(0, [])
    return best[0]


def test_plans_are_near_the_best_possible():
    rng = random.Random(6)
    extra = 0
    for _ in range(150):
        capacity = rng.choice((10, 24, 60))
        lengths = sorted((rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 10))), reverse=True)
        plan = packing.Plan(Counter(lengths), capacity)
        extra += plan.used - best_possible(lengths, capacity)
        large = [x for x in lengths if 3 * x > capacity]
        assert packing.Plan(Counter(large), capacity).used == best_possible(large, capacity)  # matching is exact
    assert extra <= 5


def test_a_plan_does_not_grow_with_the_pieces():
    rng = random.Random(1)
    counts = {length: rng.randrange(1, 50) for length in range(1, 2049)}
    small, large = packing.Plan(counts), packing.Plan({k: v * 10**9 for k, v in counts.items()})
    assert len(large.rows) < 3 * len(small.rows) < 60_000
    assert large.used < 1.02 * sum(k * v * 10**9 for k, v in counts.items()) / 2048


def expected_variants(rows, least_letters=5, least_count=3, one_in=97):
    n = Counter()
    for doc, text in ((r[0], r[1]) for r in rows):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc}:{word}".encode())
            if doc is not None and one_in and h % one_in == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    n = {w: c for w, c in n.items() if len(w) >= least_letters and c >= least_count}
    near, blank = defaultdict(set), defaultdict(set)
    for w in n:
        for k in range(len(w)):
            blank[w[:k], w[k + 1 :]].add(w)
            if w[:k] + w[k + 1 :] in n:
                near[w].add(w[:k] + w[k + 1 :])
                near[w[:k] + w[k + 1 :]].add(w)
    for some in blank.values():
        for w in some:
            near[w] |= some - {w}
    best = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: b for w, b in best.items() if n[b] >= 2 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(((w, form.get(w), root(w), c, len(near[w]), n.get(form.get(w))) for w, c in n.items()), key=repr)


def spelled(seed=3):
    """Texts in which words differ by an edit, anagrams abound, and counts tie."""
    rng = random.Random(seed)
    bases = ["".join(rng.choice("aeinrst") for _ in range(rng.randrange(4, 9))) for _ in range(60)]
    bases += ["éàçùö", "ÀÉÎõü", "naïveté", "a" * 300, "a" * 299, "ab" * 40, "×÷××÷", "straße"]

    def edited(word):
        k, letter = rng.randrange(len(word)), rng.choice("aeinrstéÿ")
        return rng.choice((word[:k] + word[k + 1 :], word[:k] + letter + word[k:], word[:k] + letter + word[k + 1 :], "".join(rng.sample(word, len(word)))))

    rows = []
    for doc in range(120):
        words = [w if rng.random() < 0.5 else edited(w) for w in rng.choices(bases, k=60)]
        rows.append((doc, rng.choice((" ", "-", "1")).join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in words), "en", "s"))
    chain = " ".join(["chainabcd"] * 3 + ["chainabce"] * 8 + ["chainabcef"] * 20)
    return rows + [(None, chain, "en", "s"), (500, None, None, None), (501, "", "en", "s"), rows[1], rows[1], (502, "x" * 40_000 + " word", "en", "s")]


@pytest.mark.parametrize("settings", [{}, {"sample": 40, "cell_words": 12}, {"sample": 100_000, "cell_words": 3}])
def test_spelling_variants(spark, settings):
    rows = spelled()
    for one_in in (97, 3):
        words = variants.vocabulary(frame(spark, rows), slip_one_in=one_in)
        got = variants.grouped(words, **settings).collect()
        want = expected_variants(rows, one_in=one_in)
        assert sum(w[4] for w in want) > 200 and any(w[1] and w[1] != w[2] for w in want)  # links, and a form's form
        assert sorted(map(tuple, got), key=repr) == want


def test_spelling_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_spelling_variants"](spark, FOLDER).collect()
    assert sorted(map(tuple, got), key=repr) == expected_variants(rows)


def test_anagrams_are_not_compared_pair_by_pair(spark):
    rng = random.Random(5)
    words = {"".join(rng.sample("abcdefgh", 8)) for _ in range(3000)} | {"".join(rng.sample("abcdefgi", 8)) for _ in range(3000)}
    frame_ = spark.createDataFrame([(w, 3) for w in sorted(words)], "word string, n long")
    got = {r.word: r.n_near for r in variants.near_words(frame_, cell_words=500).collect()}
    near = Counter()
    for w in words:
        if "h" in w and w.replace("h", "i") in words:
            near[w] += 1
            near[w.replace("h", "i")] += 1
    assert got == near


def test_every_search_finds_what_it_should():
    rng = np.random.default_rng(2)
    vectors = np.unique(rng.integers(0, 3, (400, 6)).astype(np.int16), axis=0)
    vectors = np.hstack([vectors, np.zeros((len(vectors), 84), np.int16)])
    tree = kdtree.Tree(vectors, 4)
    assert sorted(np.concatenate(tree.members).tolist()) == list(range(len(vectors)))
    for gain, lose in ((0, 0), (1, 1), (0, 1)):
        row, leaf = tree.search(vectors, gain, lose)
        seen = {(r, m) for r, f in zip(row.tolist(), leaf.tolist()) for m in tree.members[f].tolist()}
        for r, vector in enumerate(vectors):
            apart = vectors - vector
            fits = (np.maximum(apart, 0).sum(1) <= gain) & (np.maximum(-apart, 0).sum(1) <= lose)
            assert {(r, m) for m in np.flatnonzero(fits).tolist()} <= seen
        assert gain + lose == 0 or len(row) < len(vectors) * len(tree.members) / 2




def test_roots_of_a_long_chain(spark):
    forms = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(37)], "word string, form string")
    assert {r.root for r in variants.roots(forms).collect()} == {"w37"}


def test_empty_tables(nothing, spark):
    assert periodic.digests(periodic.periodic_runs(periodic.with_repeated_tails(nothing))).collect() == []
    assert packing.placed(packing.pieces(nothing)).collect() == []
    assert variants.grouped(variants.vocabulary(nothing)).collect() == []


def test_texts_without_a_word(spark):
    rows = [(k, text, None, None) for k, text in enumerate((None, "", " ", "...", "1 2 3"))]
    assert variants.grouped(variants.vocabulary(frame(spark, rows), slip_one_in=97)).collect() == []
    got = periodic.digests(periodic.periodic_runs(periodic.with_repeated_tails(frame(spark, rows)))).collect()
    assert {(r.n_runs, r.start, r.exponent_milli) for r in got} == {(0, None, None)}
    assert packing.placed(packing.pieces(frame(spark, rows))).agg(F.countDistinct("sequence_id")).first()[0] == 1
