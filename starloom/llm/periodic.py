"""Runs of words that repeat with a period, found from suffix classes.

Two places of a text whose suffixes agree in l words lie in one class of the level l. Classes are
united from the highest level down. Where the union makes two places neighbours that lie p <= l
words apart, the words from the first on repeat with period p for p + l words; p is the smallest
period there, as a smaller one would have put a place between the two. Every run shows once in
this way: as the pair of its first word and the word a period later.

Levels under that of the shortest run in demand cannot seed one and are left out.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import few_rows, text_blocks
from starloom.llm.words import IS_SPACE, Words, find_words

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
BLOCK = 1024
RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class Places:
    """An ordered set of word numbers, in blocks so that a large one takes new members fast."""

    def __init__(self, place: int):
        self.blocks, self.firsts, self.size = [[place]], [place], 1

    def __iter__(self) -> Iterator[int]:
        return (place for block in self.blocks for place in block)

    def add(self, place: int) -> tuple[int, int]:
        """Adds a place and gives the ones before and after it, -1 if there is none."""
        blocks, firsts = self.blocks, self.firsts
        of = max(bisect_right(firsts, place) - 1, 0)
        block = blocks[of]
        at = bisect_left(block, place)
        before = block[at - 1] if at else (blocks[of - 1][-1] if of else -1)
        after = block[at] if at < len(block) else (blocks[of + 1][0] if of + 1 < len(blocks) else -1)
        block.insert(at, place)
        if not at:
            firsts[of] = place
        if len(block) > BLOCK:
            blocks[of : of + 1] = [block[: BLOCK // 2], block[BLOCK // 2 :]]
            firsts.insert(of + 1, blocks[of + 1][0])
        self.size += 1
        return before, after


def suffix_levels(values: np.ndarray, text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The places of a block in suffix order, text by text, and classes by width 1, 2, 4, ...

    Places of a text have equal classes of width w if the w words from there on are the same.
    Each width follows from the one before; only places that still share a class are sorted.
    """
    count = len(values)
    key = text.astype(np.int64) * (int(values.max(initial=0)) + 1) + values
    classes, active, width, levels = np.zeros(count, np.int64), np.arange(count), 0, []
    while len(active):
        if width:
            later = active + width
            second = np.where(later < ends[active], classes[np.minimum(later, count - 1)], -1)
            key = classes[active] * (count + 1) + second + 1
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        old = classes[active]
        news = np.ones(len(active), bool)
        news[1:] = key[1:] != key[:-1]
        olds = np.ones(len(active), bool)
        olds[1:] = old[1:] != old[:-1]
        at = np.arange(len(active))
        renamed = old + np.maximum.accumulate(np.where(news, at, 0)) - np.maximum.accumulate(np.where(olds, at, 0))
        classes = classes.copy()
        classes[active] = renamed
        levels.append(classes.astype(np.int32))
        lone = news.copy()
        lone[:-1] &= news[1:]
        active = active[~lone]
        width = 2 * width or 1
    order = np.zeros(count, np.int64)
    order[classes] = np.arange(count)
    return order, levels


def neighbours(order: np.ndarray, levels: list[np.ndarray], ends: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Neighbours in suffix order that agree in `least` words or more, and in how many."""
    wide = least.bit_length() - 1
    if len(levels) <= wide:
        return (np.zeros(0, np.int64),) * 3
    a, b = order[:-1], order[1:]
    same = levels[wide][a] == levels[wide][b]
    a, b = a[same], b[same]
    agree = np.zeros(len(a), np.int64)
    for step in range(len(levels) - 1, -1, -1):
        x, y = a + agree, b + agree
        inside = (x < ends[a]) & (y < ends[b])
        last = len(order) - 1
        agree += (inside & (levels[step][np.minimum(x, last)] == levels[step][np.minimum(y, last)])).astype(np.int64) << step
    enough = agree >= least
    return a[enough], b[enough], agree[enough]


def runs_of(pairs: list[tuple[int, int, int]], words: list[int], least_length: int, least_exponent: int) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of one text, from its pairs (agree, place, place), highest first."""
    sets: dict[int, Places] = {}
    following: dict[int, int] = {}
    found, fresh, level = [], [], -1

    def settle() -> None:
        for a, b in fresh:
            # another union of the level may have put a place between the two since
            if following[a] == b and (a == 0 or words[a - 1] != words[b - 1]):
                found.append((a, b - a + level, b - a))
        fresh.clear()

    for agree, a, b in pairs:
        if agree != level:
            settle()
            level = agree
        large, small = sets.get(a) or sets.setdefault(a, Places(a)), sets.get(b) or sets.setdefault(b, Places(b))
        if large.size < small.size:
            large, small = small, large
        last = -1  # the place added before: neighbours of the smaller set are not new ones
        for place in small:
            before, after = large.add(place)
            sets[place] = large
            following[place] = after
            if before >= 0:
                following[before] = place
                if before != last and level + place - before >= max(least_length, least_exponent * (place - before)):
                    fresh.append((before, place))
            last = place
            if after >= 0 and level + after - place >= max(least_length, least_exponent * (after - place)):
                fresh.append((place, after))
    settle()
    return sorted(found)


def word_ids(words: Words) -> np.ndarray:
    """The same number for the same word."""
    data = np.ascontiguousarray(words.data[~IS_SPACE[words.data]])
    offsets = np.zeros(len(words.starts) + 1, np.int64)
    np.cumsum(words.ends - words.starts, out=offsets[1:])
    column = pa.Array.from_buffers(pa.large_binary(), len(words.starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


def joined(words: Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words (by number) of each text of a block, one blank between them: bytes, offsets."""
    sizes = words.ends[kept] - words.starts[kept] + 1
    at = np.zeros(len(kept) + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    source = np.repeat(words.starts[kept] - at[:-1], sizes) + np.arange(at[-1])
    data = words.data[np.minimum(source, max(len(words.data) - 1, 0))]
    data[at[1:] - 1] = 0x20
    counts = np.bincount(words.text[kept], minlength=len(words.counts))
    bounds = at[np.concatenate(([0], np.cumsum(counts)))]
    lasts = bounds[1:][counts > 0] - 1  # no blank after the last word of a text
    offsets = bounds.copy()
    offsets[1:] -= np.cumsum(counts > 0)
    return np.delete(data, lasts), offsets


def periodic_runs(documents: DataFrame, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (start, length, period, by start and period) and the collapsed text.

    A run is a stretch with a smallest period, as long as `least_length` words and
    `least_exponent` periods at least, and not to be extended. The collapsed text keeps of each
    run the words of its first period, joined by one blank. A null text has no words. Rows stand
    alone: repeated ones and those without a doc_id give a result each; other columns are left
    out. A text is indexed by one task, which holds some 200 bytes a word of it. An empty table
    gives an empty result. `least_exponent` is 2 or more.
    """
    if least_exponent < 2:
        raise ValueError("a run repeats its period once at least")
    periods = range(1, least_length + 1)
    least = max(min(max(least_length, least_exponent * p) - p for p in periods), 1)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches, 2048):
            for first, last, data, offsets in text_blocks(batch.column(1)):
                words = find_words(data, offsets)
                runs: list[list[tuple[int, int, int]]] = [[] for _ in words.counts]
                kept = np.arange(len(words.starts))
                if len(kept):
                    values = word_ids(words)
                    ends = (words.firsts + words.counts)[words.text]
                    a, b, agree = neighbours(*suffix_levels(values, words.text, ends), ends, least)
                    order = np.lexsort((-agree, words.text[a]))
                    a, b, agree = a[order], b[order], agree[order]
                    texts, starts = np.unique(words.text[a], return_index=True)
                    gone = np.zeros(len(kept) + 1, np.int64)
                    for text, lo, hi in zip(texts.tolist(), starts, [*starts[1:], len(a)]):
                        base, end = words.firsts[text], words.firsts[text] + words.counts[text]
                        pairs = list(zip(agree[lo:hi].tolist(), (a[lo:hi] - base).tolist(), (b[lo:hi] - base).tolist()))
                        runs[text] = runs_of(pairs, values[base:end].tolist(), least_length, least_exponent)
                        for start, length, period in runs[text]:
                            gone[base + start + period] += 1
                            gone[base + start + length] -= 1
                    kept = kept[np.cumsum(gone[:-1]) == 0]
                data, offsets = joined(words, kept)
                flat = [run for some in runs for run in some]
                parts = [pa.array([run[k] for run in flat], pa.int64()) for k in range(3)]
                bounds = np.concatenate(([0], np.cumsum([len(some) for some in runs]))).astype(np.int32)
                listed = pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays(parts, ["start", "length", "period"]))
                text = pa.Array.from_buffers(
                    pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:last], pa.array(words.counts, pa.int64()), listed, text.cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, RUNS)


def with_repeated_tails(documents: DataFrame) -> DataFrame:
    """doc_id and text; every tenth document by the checksum of its doc_id goes on with the same
    p words from its word a on. Texts of these are joined by one blank, others are as they were;
    so are those of rows without a doc_id."""
    drawn = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(drawn / 10)

    def changed(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        source = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        repeated = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, source(i).cast("int")))
        return F.when(n > 0, F.concat_ws(" ", repeated))

    # the words are an element of an array, so that they are found once and not once a word
    found = F.array(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)")))
    tail = F.get(F.transform(found, changed), 0)
    return documents.select("doc_id", F.when(drawn % 10 == 0, tail).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Per document the number of its runs, the longest one, and checksums of runs and kept words."""
    rank = F.transform("runs", lambda r: F.struct((-r.length).alias("minus"), r.start.alias("start"), r.period.alias("period")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    best = F.col("best")
    length = -best.getField("minus")
    return found.select("*", F.array_min(rank).alias("best")).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.getField("start").alias("start"),
        length.alias("length"), best.getField("period").alias("period"),
        F.floor(1000 * length / best.getField("period")).alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
