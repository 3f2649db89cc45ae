"""Preference pairs and decontamination."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from starloom.llm import decontamination, preference
from llm.conftest import frame, sentence, words_of

TURNS = "pair_id long, turn long, role string, text string, prompt string"


def render(turns):
    text, spans = "", []
    for role, body in turns:
        text += f"<|im_start|>{role or ''}\n"
        end = len(text) + len(body or "") + len("<|im_end|>\n")
        if role == "assistant":
            spans.append((len(text), end))
        text += (body or "") + "<|im_end|>\n"
    return text, spans


def test_preference_pairs_against_brute_force(spark):
    rng = random.Random(6)
    chosen, rejected = {}, {}
    for pair in range(60):
        turns = [(rng.choice(("user", "assistant", None)), rng.choice(("hi", "é", "", None, "long " * 50))) for _ in range(rng.randrange(7))]
        other = turns[: rng.randrange(8)] + [("assistant", rng.choice("xyz"))] * rng.randrange(3)
        chosen[pair], rejected[pair] = turns, other
    tables = [
        spark.createDataFrame([(p, k * 2, r, t, "clash") for p, ts in side.items() for k, (r, t) in enumerate(ts)], TURNS).repartition(3)
        for side in (chosen, rejected)
    ]
    got = {r.pair_id: r for r in preference.preference_pairs(*tables).collect()}
    assert set(got) == {p for p in chosen if chosen[p] or rejected[p]}
    for pair, r in got.items():
        a, b = chosen[pair], rejected[pair]
        n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert r.n_shared_turns == n and r.prompt == render(a[:n])[0]
        assert (r.chosen, [tuple(s) for s in r.chosen_spans]) == render(a[n:])
        assert (r.rejected, [tuple(s) for s in r.rejected_spans]) == render(b[n:])


def test_preference_pairs_of_odd_rows(spark):
    rows = [(None, 0, "user", "hi", ""), (None, None, "assistant", "last", ""), (1, 0, "user", "b", ""), (1, 0, "user", "a", ""), (1, 0, "user", "a", "")]
    table = spark.createDataFrame(rows, TURNS)
    got = {r.pair_id: r for r in preference.preference_pairs(table, table.where("pair_id = 1")).collect()}
    assert got[1].n_shared_turns == 3 and got[1].chosen == got[1].rejected == "" and got[1].prompt.count("\na<") == 2
    assert got[None].n_shared_turns == 0 and got[None].chosen.endswith("last<|im_end|>\n") and got[None].rejected == ""
    empty = table.where("false")
    assert preference.preference_pairs(empty, empty).collect() == []
    assert preference.neighbour_replies(empty.withColumnRenamed("pair_id", "conv_id"))[0].collect() == []


def multiset_similarity(a, b):
    shared = sum((a & b).values())
    return shared, sum(a.values()) + sum(b.values()) - shared


def grams(words, width):
    return Counter(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def expected_leaks(rows, items):
    out = Counter()
    for doc, text, *_ in rows:
        words, found = words_of((text or "").lower()), {}
        for item, body in items:
            asked = words_of((body or "").lower())
            width = min(5, len(asked))
            size = min(len(asked), len(words))
            if not width or size < width:
                continue
            for k in range(len(words) - size + 1):
                shared, total = multiset_similarity(grams(words[k : k + size], width), grams(asked, width))
                if 100 * shared >= 75 * total:
                    found[item] = max(found.get(item, 0), 100 * shared // total)
        out[doc, len(words), len(found), ",".join(map(str, sorted(found))), max(found.values(), default=0), not found] += 1
    return out


def test_leaks_against_brute_force(spark):
    rng = random.Random(9)
    items = [(k, sentence(rng, n)) for k, n in enumerate((3, 5, 9, 20, 20, 33, 60))] + [(7, None), (8, "  "), (9, "the the the the the the the the the")]
    rows = [(k, sentence(rng, rng.randrange(120)), "en", "s") for k in range(25)]
    for k, (item, body) in enumerate(items * 3):
        parts = (body or "").split()
        if k >= len(items) and len(parts) > 8:
            parts[0 if k % 2 else len(parts) // 2] = "changed"
        rows.append((100 + k, f"{sentence(rng, 30)}\n{' '.join(parts).upper()} {sentence(rng, 20)}", "en", "s"))
    rows += [(200, items[4][1][: len(items[4][1]) * 9 // 10], "en", "s"), (201, None, None, None), (202, "", None, None), (None, items[5][1], None, None)]
    rows.append((203, "the " * 300, "en", "s"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.decontaminated(frame(spark, rows), benchmark).collect()
    assert Counter(map(tuple, got)) == expected_leaks(rows, items)
    assert all(r.kept for r in decontamination.decontaminated(frame(spark, rows), benchmark.where("false")).collect())
    assert decontamination.decontaminated(frame(spark, []), benchmark).collect() == []


def test_very_long_items(spark):
    """An item of more words than narrow counters hold, and most of it as a document."""
    rng = random.Random(7)
    long = [f"w{rng.randrange(9000)}" for _ in range(decontamination.NARROW + 9000)]
    few = [rng.choice(("a", "b")) for _ in range(60)]
    benchmark = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(few))], "item_id long, text string")
    rows = [
        (0, " ".join(long[:-5000]), "en", "s"), (1, " ".join(long[:20_000]), "en", "s"),
        (2, "start " + " ".join(few) + " end", "en", "s"), (3, " ".join(rng.choice(("a", "b")) for _ in range(40)), "en", "s"),
    ]
    got = {r.doc_id: (r.items, r.best_percent) for r in decontamination.decontaminated(frame(spark, rows), benchmark).collect()}
    assert got == {0: ("1", 93), 1: ("", 0), 2: ("2", 100), 3: ("", 0)}


def test_wide_counters_give_the_same_marks(spark):
    values = spark.createDataFrame([([random.Random(k).getrandbits(62) for _ in range(k + 1)],) for k in range(30)], "v array<long>")
    both = values.select(*(F.expr(decontamination._counted("v", width)).alias(f"m{width}") for width in (16, 32))).collect()
    assert all(r.m16 == r.m32 for r in both) and len({r.m16 for r in both}) == 30


def test_shared_weight_counts_repeats(spark):
    rng = random.Random(4)
    pairs = [([rng.randrange(6) for _ in range(rng.randrange(12))], [rng.randrange(6) for _ in range(rng.randrange(12))]) for _ in range(80)]
    got = spark.createDataFrame(pairs, "a array<long>, b array<long>").select("a", "b", decontamination.shared_weight(F.col("a"), F.col("b")).alias("n"))
    for a, b, n in got.collect():
        assert n == sum((Counter(a) & Counter(b)).values())


def test_blocks_cover_all_bits():
    masks = [m % (1 << 64) for m in decontamination.blocks(24)]
    assert len(masks) == 25 and sum(masks) == (1 << 64) - 1 and all(masks)


def test_native_plans_have_no_python(spark, documents):
    from starloom.llm.queries import QUERIES

    for name in ("op1_preference_pairs", "op6_simhash_decontamination"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Arrow" not in plan and "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
