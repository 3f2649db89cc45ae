"""Windows and spans against brute force, on every odd case."""

from __future__ import annotations

import hashlib
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from starloom.llm import common, repeats, sketch, spans
from llm.conftest import frame, words_of


def expected_words(rows, width):
    lists = [words_of(r[1]) for r in rows]
    count = Counter(tuple(w[k : k + width]) for w in lists for k in range(len(w) - width + 1))
    out = []
    for row, words in zip(rows, lists):
        gone = set()
        for k in range(len(words) - width + 1):
            if count[tuple(words[k : k + width])] > 1:
                gone.update(range(k, k + width))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((row[0], len(words), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_words_in_repeated_windows_go(documents, rows):
    for width, gram in ((35, 16), (8, 3)):
        got = repeats.without_repeats(documents, width, gram).collect()
        assert sorted(map(tuple, got), key=repr) == expected_words(rows, width)


def test_a_full_sketch_loses_nothing(documents, rows):
    got = repeats.without_repeats(documents, most_bits=17).collect()
    assert sorted(map(tuple, got), key=repr) == expected_words(rows, 35)


def expected_bytes(rows, width):
    first = {}
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    for doc, text in texts:
        if doc is not None:
            for k in range(len(text) - width + 1):
                window = text[k : k + width]
                first[window] = min(first.get(window, doc), doc)
    out = []
    for doc, text in texts:
        gone = bytearray(len(text))
        if doc is not None:
            for k in range(len(text) - width + 1):
                if first[text[k : k + width]] < doc:
                    gone[k : k + width] = b"\1" * width
        kept = bytes(c for c, g in zip(text, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((doc, len(text), sum(gone), runs, kept, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_bytes_of_earlier_documents_go(documents, rows):
    for width, gram in ((50, 20), (20, 8)):
        got = [(*r[:4], bytes(r[4]), r[5]) for r in spans.without_earlier(documents, width, gram).collect()]
        assert sorted(got, key=repr) == expected_bytes(rows, width)


def test_empty_tables(nothing):
    assert repeats.without_repeats(nothing).collect() == []
    assert spans.without_earlier(nothing).collect() == []


def flat(strings):
    return np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings], np.int64)


def drawn(rng, count, letters, least, most):
    return [bytes(rng.integers(97, 97 + letters, rng.integers(least, most)).astype(np.uint8)) for _ in range(count)]


def test_matching_statistics_of_strings_the_index_does_not_hold():
    rng = np.random.default_rng(3)
    for letters, window in ((2, 5), (4, 9), (1, 5)):
        held = drawn(rng, 40, letters, window, 40) + [b"a" * 30, b"a" * 30, b"\0\0a\0" * 5]
        asked = drawn(rng, 40, letters + 1, 1, 60) + [b"\xff" * 9, b"\0\0a\0\0\0"] + held[:3]
        docs = rng.permutation(len(held))
        index = spans.RunIndex(*flat(held), docs, window)
        text = b"|".join(held) + b"|"  # as many places as the index has
        seen = 0
        for string, start, matched, place in index.statistics(*flat(asked)):
            for s, k, n, at in zip(string.tolist(), start.tolist(), matched.tolist(), place.tolist()):
                longest = max(m for m in range(len(asked[s]) - k + 1) if any(asked[s][k : k + m] in h for h in held))
                assert n == longest and (not n or text[at : at + n] == asked[s][k : k + n])
                if n >= window:
                    piece = asked[s][k : k + window]
                    assert index.smallest_at[at] == min(d for h, d in zip(held, docs) if piece in h)
                seen += 1
        assert seen == sum(map(len, asked)) and len(index.run_start) < len(text)

        def long_matches(steps):
            return {(s, k) for string, start, n, _ in steps for s, k in zip(string[n >= window].tolist(), start[n >= window].tolist())}

        assert long_matches(index.statistics(*flat(asked), window)) == long_matches(index.statistics(*flat(asked)))


def test_smallest_documents_against_brute_force():
    rng = np.random.default_rng(4)
    for letters in (2, 3):
        groups = [drawn(rng, n, letters, 6, 30) for n in (1, 2, 9, 70)]
        # equal windows are of one anchor only: a letter of its own for each
        strings = [s.translate(bytes((b + 10 * g) % 256 for b in range(256))) for g, some in enumerate(groups) for s in some]
        anchors = np.repeat(np.arange(4), [len(g) for g in groups])
        docs = rng.integers(0, 40, len(strings))
        got = spans.smallest_documents(*flat(strings), docs, anchors, 6).tolist()
        assert got == [min(d for t, d in zip(strings, docs) if s[k : k + 6] in t) for s in strings for k in range(len(s) - 5)]


def stretches(strings, anchors):
    data, lengths = flat(strings)
    where = np.zeros(len(strings), spans._WHERE)
    where["key"] = where["doc"] = np.arange(len(strings))
    return spans.Rows(np.array(anchors, np.uint64), lengths, data, np.ones(len(strings), np.int64), where)


def test_only_strings_with_a_long_passage_in_common_are_indexed(monkeypatch):
    rng = np.random.default_rng(6)
    own = drawn(rng, 300, 26, 34, 35)
    strings = [a + b"sixteen letters!" + a[::-1] for a in own]
    held = []

    class Counted(spans.RunIndex):
        def __init__(self, data, lengths, *rest):
            held.extend(lengths.tolist())
            super().__init__(data, lengths, *rest)

    monkeypatch.setattr(spans, "RunIndex", Counted)
    assert [b.num_rows for b in spans.judged(stretches(strings, [7] * 300), 50)] == [0] and held == []
    strings += [a[1:] + b"sixteen letters!" + a[:-9:-1] + b"?" * 26 for a in own[:20]] + strings[20:30]
    got = {tuple(r.values()) for b in spans.judged(stretches(strings, [7] * len(strings)), 50) for r in b.to_pylist()}
    assert held and len(held) <= 3 * 2 * 20
    least = {}
    for doc, s in enumerate(strings):
        for k in range(len(s) - 49):
            least.setdefault(s[k : k + 50], doc)
    gone = {(doc, b) for doc, s in enumerate(strings) for k in range(len(s) - 49) if least[s[k : k + 50]] < doc for b in range(k, k + 50)}
    assert gone and {(doc, b) for _, doc, first, last in got for b in range(first, last)} == gone


def test_hashes_of_stretches_take_little_memory(monkeypatch):
    rng = np.random.default_rng(7)
    rows = stretches(drawn(rng, 1, 26, 400_000, 400_001) + drawn(rng, 60_000, 26, 50, 85), range(60_001))
    ends = np.cumsum(rows.lengths)
    whole = spans._ROLLS[1].slices(spans._ROLLS[1].sums(spans._VALUES[1][rows.data]), ends - rows.lengths, ends)
    monkeypatch.setattr(spans, "_ROLLS", [spans.Rolling(f"spans {k}") for k in range(2)])
    tracemalloc.start()
    try:
        got = rows.context()
        assert tracemalloc.get_traced_memory()[1] < 12 * len(rows.data)
    finally:
        tracemalloc.stop()
    assert got.tolist() == whole.tolist()


def test_byte_anchors_at_many_places_are_split(documents, rows):
    for most_places in (0, 3):
        got = [(*r[:4], bytes(r[4]), r[5]) for r in spans.without_earlier(documents, 20, 8, most_places=most_places).collect()]
        assert sorted(got, key=repr) == expected_bytes(rows, 20)


def test_a_phrase_of_sixteen_bytes_in_every_document(spark):
    rng = np.random.default_rng(5)
    own = [drawn(rng, 1, 26, 60, 90)[0].decode() for _ in range(400)]
    rows = [(k, f"{a} sixteen letters! {a[::-1]}", "en", "s") for k, a in enumerate(own)]
    rows += [(400 + k, f"{own[k][7:]} sixteen letters! {own[k][::-1][:70]} x", "en", "s") for k in range(0, 400, 9)]
    for most_places in (50, spans.MOST_PLACES):
        got = [(*r[:4], bytes(r[4]), r[5]) for r in spans.without_earlier(frame(spark, rows), most_places=most_places).collect()]
        assert sorted(got, key=repr) == expected_bytes(rows, 50)
        assert sum(r[2] > 0 for r in got) == 45


def test_spans_at_an_anchor_of_many_places_come_out_united(spark):
    rows = [(k, f"own{k} " + "ab cd " * 60 + f"end{k} " + "ab cd " * 40 + f"last{k}", "en", "s") for k in range(30)]
    docs = frame(spark, rows)
    got = [(*r[:4], bytes(r[4]), r[5]) for r in spans.without_earlier(docs, most_places=50).collect()]
    assert sorted(got, key=repr) == expected_bytes(rows, 50)
    found = Counter(r.doc_id for r in spans.earlier_windows(docs, most_places=50).collect())
    assert sorted(found) == list(range(1, 30)) and max(found.values()) < 10  # not one a place, of which there are about a hundred


def test_united_spans():
    def united(some):
        return [tuple(r.values()) for r in spans._united(pa.RecordBatch.from_pylist([dict(zip(("row_key", "doc_id", "first", "last"), x)) for x in some], schema)).to_pylist()]

    schema = pa.schema([(c, pa.int64()) for c in ("row_key", "doc_id", "first", "last")])
    assert united([]) == []
    assert united([(5, 1, 40, 90), (-3, 1, 0, 50), (5, 1, 0, 50), (5, 2, 60, 110), (-3, 1, 50, 100), (-3, 1, 101, 151), (5, 1, 10, 60)]) == [
        (-3, 1, 0, 100), (-3, 1, 101, 151), (5, 1, 0, 90), (5, 2, 60, 110)
    ]


def test_stretches_of_many_places_are_cut_again_only_where_many_differ(spark, monkeypatch):
    labels = []

    def written(frame, label):
        labels.append(label)
        return common.written(frame, label)

    monkeypatch.setattr(spans, "written", written)
    rng = np.random.default_rng(8)
    own = [s.decode() for s in drawn(rng, 300, 26, 60, 61)]
    passage, line = drawn(rng, 1, 26, 200, 201)[0].decode(), "a line of some forty bytes in every text"
    schema = "anchor long, context long, stretch binary, doc long"

    def least(texts, most):
        labels.clear()
        data, lengths = flat([t.encode() for t in texts])
        cut = spans.Stretches(data, np.concatenate(([0], np.cumsum(lengths))), 50, 16)
        strings = [bytes(data[a : a + n + 49]) for a, n in zip(cut.first.tolist(), cut.count.tolist())]
        context = spans._ROLLS[1].slices(spans._ROLLS[1].sums(spans._VALUES[1][data]), cut.first, cut.first + cut.count + 49)
        keys = list(zip(cut.anchor.view(np.int64).tolist(), context.view(np.int64).tolist()))
        rows = [(*key, s, t) for key, s, t in zip(keys, strings, cut.text.tolist())]
        smallest = {}
        for _, _, s, t in rows:
            for k in range(len(s) - 49):
                smallest[s[k : k + 50]] = min(t, smallest.get(s[k : k + 50], t))
        got = spans.least_documents(spark.createDataFrame(rows, schema).repartition(3), 50, 16, most, 2).collect()
        assert len(got) == len(set(keys))
        verdicts = {(r.anchor, r.context): r.smallest for r in got}
        assert verdicts == {(a, c): [smallest[s[k : k + 50]] for k in range(len(s) - 49)] for a, c, s, _ in rows}
        return labels.count("pieces")

    assert least([passage] * 300, 20) == 0  # at 300 places, but one string each
    assert least([f"{a} sixteen letters! {a[::-1]}" for a in own], 20) == 1  # a short phrase, the longer anchors differ
    assert least([f"{a} {line} {a[::-1]}" for a in own] + [own[7] + " " + line] * 3, 20) == 2  # a long line, in the end by windows


def test_sketch_never_misses(spark):
    values = spark.createDataFrame([(str(k % 700),) for k in range(1000)], "text string").repartition(5)

    def keys(column):
        yield np.array([int(x) for x in column.to_pylist()], np.uint64)

    for bits in (17, 20):
        made = sketch.build(values, keys, 1000, bits)
        assert made.maybe_repeated(np.arange(300, dtype=np.uint64)).all()
        assert made.maybe_repeated(np.arange(300, 700, dtype=np.uint64)).mean() < 0.1


def test_a_passage_in_every_document(spark):
    passage = " ".join(f"w{k}" for k in range(40))
    rows = [(k, f"own{k} {passage} end{k}", "en", "s") for k in range(300)]
    got = repeats.without_repeats(frame(spark, rows)).collect()
    assert {(r.n_removed, r.kept_text) for r in got} == {(40, f"own{k} end{k}") for k in range(300)}


def test_heavy_anchors_are_split(spark, documents, rows):
    for most_rows in (0, 2):
        got = repeats.without_repeats(documents, 8, 3, most_rows=most_rows).collect()
        assert sorted(map(tuple, got), key=repr) == expected_words(rows, 8)


def test_no_task_holds_a_heavy_anchor(spark):
    passage = " ".join(f"w{k}" for k in range(40))
    own = [" ".join(f"{side}{k}x{j}" for j in range(9)) for k in range(300) for side in "ab"]
    rows = [(k, f"{own[2 * k]} {passage} {own[2 * k + 1]}", "en", "s") for k in range(300)] + [(300, f"{own[0]} once", "en", "s")]
    docs = frame(spark, rows)
    assert sorted(map(tuple, repeats.without_repeats(docs, most_rows=20).collect()), key=repr) == expected_words(rows, 35)
    stretches = spark.createDataFrame([(a, c, b"w" * 8, 1) for a in range(3) for c in range((5, 20, 300)[a])], "anchor long, context long, windows binary, n long")
    light, heavy = repeats.parted(stretches, 20)
    assert {r.anchor for r in light.collect()} == {0, 1} and {r.anchor for r in heavy.collect()} == {2}
    verdicts = repeats.split_verdicts(heavy)
    plan = verdicts._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and plan.count("MapInArrow") == 2  # nothing but the explosions runs in Python
    assert {r.mask for r in verdicts.collect()} == {1} and verdicts.count() == 300
