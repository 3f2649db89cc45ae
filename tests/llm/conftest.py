from __future__ import annotations

import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EXTRA = ("kept", "size", "target", "row_key", "shard_id", "n_words", "mix_key", "a", "b", "node", "words", "lane", "level", "cell", "h", "shard", "cell6", "shard6", "shard_level", "shard_cell", "buckets")


def words_of(text):
    return WORD.findall(text or "")


def sentence(rng, n):
    return " ".join(rng.choice(("the", "of", "and", "river", "stone", "é", "Bread", "valley", "rain,", "over.")) + str(rng.randrange(9)) for _ in range(n))


def corpus(seed=5, copies=3):
    """(doc_id, text, lang, source): copies, near copies, shared passages and every odd case."""
    rng = random.Random(seed)
    texts = [sentence(rng, rng.choice((3, 4, 5, 12, 60, 90, 140))) for _ in range(24)]
    passage = sentence(rng, 45)
    rows = []
    for k, text in enumerate(texts):
        rows.append((text, "en", f"s{k % 4}"))
        if k % 5 == 0:
            rows.extend([(text, "en", "s0")] * copies)
        if k % 5 == 1:
            parts = text.split()
            parts[len(parts) // 2] = "changed"
            rows.append((" ".join(parts), "en", "s1"))
        if k % 6 == 2:
            rows.append((text[: len(text) // 2] + "\n" + passage + "\n" + text[len(text) // 2 :], "de", "s2"))
    rows += [(None, "en", "s0"), ("", "en", None), (" \t\n ", None, "s3"), ("one", None, None), ("x " * 200, "en", "s2"), ("ab" * 90, "en", "s2")]
    rows.append((sentence(rng, 4000), "en", "s3"))  # long
    rng.shuffle(rows)
    return [(k, *row) for k, row in enumerate(rows)]


SCHEMA = "doc_id long, text string, lang string, source string"


def frame(spark, rows, extra=True):
    from pyspark.sql import functions as F

    out = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return out.withColumns({name: F.lit("clash") for name in EXTRA}) if extra else out


@pytest.fixture(scope="module")
def rows():
    found = corpus()
    return found + [found[3], (None, found[0][1], "en", "s0"), (None, None, None, None)]  # a repeated row, rows without id


@pytest.fixture(scope="module")
def documents(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])
