"""Quality rules: basic counts, and how far a text is from the references of its language.

Each language has two references, gathered from all its documents: the shares of character
classes, and the shares of its common words (and of all others). A document is compared by
Jensen-Shannon distance, from 0 for equal shares to 1 for none in common. Short texts are not
judged so, as a few words have no stable shares.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import text_blocks
from starloom.llm.words import LOWER, Words, find_words, mix, window_hashes

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: Texts with fewer words are not compared with the references.
LEAST_COMPARED_WORDS = 80
#: Languages with fewer words have no references.
LEAST_REFERENCE_WORDS = 2000
COMMON_WORDS = 40
#: A word counts as common only if it makes up this share of its language.
COMMON_SHARE = 0.002
COUNTERS = 2000
MOST_CLASS_DISTANCE = 0.25
MOST_WORD_DISTANCE = 0.4

CLASSES = ("lower", "upper", "digit", "space", "stop", "mark", "symbol", "beyond_ascii")
_CLASS = np.full(256, 5, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[0x20, *range(0x09, 0x0E)]] = 3
_CLASS[[ord(c) for c in ".,;:?'-"]] = 4
_CLASS[[ord(c) for c in "#*$%&|<>"]] = 6
_CLASS[0xC0:] = 7
_CLASS[0x80:0xC0] = 8  # inside a code point: not counted
_SYMBOL = _CLASS == 6
_ENDING = np.zeros(256, bool)
_ENDING[[ord(c) for c in ".,;:!?"]] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points of each class, one row per text."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return np.bincount(text * 9 + _CLASS[data], minlength=9 * (len(offsets) - 1)).reshape(-1, 9)[:, :8]


def plain_words(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words in lower case, without one mark at the end."""
    ends = words.ends - (_ENDING[words.data[words.ends - 1]] & (words.ends - words.starts > 1)) if len(words.ends) else words.ends
    plain = Words(LOWER[words.data], words.starts, ends, words.text, words.counts, words.firsts)
    return plain.hashes(), words.starts, ends


def _duplicates(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return again


def repeated_words(words: Words, hashes: np.ndarray, width: int = 3) -> np.ndarray:
    """Words of each text that stand in a window of three found twice or more in the text."""
    starts = words.windows(width)
    covered = np.zeros(len(hashes) + width, bool)
    if len(starts):
        keys = window_hashes(hashes, starts, width) ^ mix(words.text[starts].astype(np.uint64))
        again = starts[_duplicates(keys)]
        for k in range(width):
            covered[again + k] = True
    return np.bincount(words.text[covered[: len(hashes)]], minlength=len(words.counts))


def repeated_lines(data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """Lines of each text that have a word and are equal to an earlier line."""
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
    starts = starts[starts < len(data)]
    if not len(starts):
        return np.zeros(len(words.counts), np.int64)
    ends = np.append(starts[1:], len(data))
    ends = ends - (data[ends - 1] == 10)
    has_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[has_word], ends[has_word]
    text = np.searchsorted(offsets, starts, "right") - 1
    lines = [Words(data, starts, ends, text, words.counts, words.firsts).hashes(k) for k in range(2)]
    order = np.lexsort((lines[1], lines[0], text))
    a, b, c = text[order], lines[0][order], lines[1][order]
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & (c[1:] == c[:-1])
    return np.bincount(a[1:][same], minlength=len(words.counts))


def basic_counts(data: np.ndarray, offsets: np.ndarray, words: Words) -> dict[str, np.ndarray]:
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    chars = heads[words.ends] - heads[words.starts]
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": np.bincount(words.text, weights=chars, minlength=len(words.counts)).astype(np.int64),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_dup_lines": repeated_lines(data, offsets, words),
        "n_repeat_words": repeated_words(words, words.hashes()),
    }


def distance(rows: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of each row of counts from the reference counts."""
    p = rows / np.maximum(rows.sum(axis=1, keepdims=True), 1)
    q = np.broadcast_to(reference / max(reference.sum(), 1), p.shape)
    middle = (p + q) / 2

    def side(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(middle > 0, middle, 1)), 0).sum(axis=1)

    return np.sqrt(np.clip((side(p) + side(q)) / 2, 0, 1))


class HeavyWords:
    """A Misra-Gries summary: counts of a stream's frequent words, each too low by `error` at most."""

    def __init__(self, counters: int = COUNTERS):
        self.counters, self.error, self.total = counters, 0, 0
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.names: dict[int, bytes] = {}

    def add(self, words: Words, which: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        found, at, n = np.unique(hashes[which], return_index=True, return_counts=True)
        self.total += len(which)
        joined, inverse = np.unique(np.concatenate((self.hashes, found)), return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate((self.counts, n)), minlength=len(joined)).astype(np.int64)
        if len(joined) > self.counters:
            least = int(np.partition(counts, -self.counters - 1)[-self.counters - 1])
            self.error += least
            joined, counts = joined[counts > least], counts[counts > least] - least
        self.hashes, self.counts = joined, counts
        kept = {}
        fresh = np.searchsorted(found, joined)
        for k, key in enumerate(joined.tolist()):
            name = self.names.get(key)
            if name is None:
                w = which[at[fresh[k]]]
                name = LOWER[words.data[starts[w] : ends[w]]].tobytes()
            kept[key] = name
        self.names = kept


def _by_language(langs: np.ndarray, words: Words):
    names, codes = np.unique(np.array(["" if x is None else "=" + x for x in langs.tolist()]), return_inverse=True)
    of_word = codes[words.text]
    for k, name in enumerate(names.tolist()):
        yield (name[1:] if name else None), np.flatnonzero(codes == k), np.flatnonzero(of_word == k)


def frequent_words(documents: DataFrame, share: float = COMMON_SHARE) -> DataFrame:
    """(lang, word): all words that make up `share` of their language, and few others.

    Every task sends `COUNTERS` counts a language at most. What the summaries may have missed
    together is known, so that no word over the share is lost.
    """

    def count(batches):
        kept: dict[str | None, HeavyWords] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for first, last, data, offsets in text_blocks(batch.column(1)):
                words = find_words(data, offsets)
                hashes, starts, ends = plain_words(words)
                for lang, _, which in _by_language(langs[first:last], words):
                    kept.setdefault(lang, HeavyWords()).add(words, which, hashes, starts, ends)
        rows = [
            (lang, name, n, 0, 0)
            for lang, heavy in kept.items()
            for name, n in zip((heavy.names[h].decode() for h in heavy.hashes.tolist()), heavy.counts.tolist())
        ]
        rows += [(lang, None, 0, heavy.error, heavy.total) for lang, heavy in kept.items()]
        columns = list(zip(*rows)) if rows else [()] * 5
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "word", "n", "error", "total"])

    sent = documents.select("lang", "text").mapInArrow(count, "lang string, word string, n long, error long, total long")
    sums = sent.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.sum("error").alias("error"), F.sum("total").alias("total"))
    totals = sums.where("word is null").select(F.col("lang").alias("of"), F.col("error").alias("missed"), F.col("total").alias("all"))
    return (
        sums.where("word is not null")
        .join(totals, F.expr("lang <=> of"))
        .where((F.col("n") + F.col("missed") >= F.col("all") * share))
        .select("lang", "word")
    )


def references(documents: DataFrame, share: float = COMMON_SHARE, common: int = COMMON_WORDS) -> dict:
    """For each language: class counts, its common words' hashes, and their counts and all others'.

    Counts are exact and of all documents. What comes to the driver is some hundred numbers a
    language.
    """
    wanted: dict[str | None, list[str]] = {}
    for lang, word in frequent_words(documents, share).collect():  # 1 / share words a language or so
        wanted.setdefault(lang, []).append(word)
    wanted = {lang: sorted(names) for lang, names in wanted.items()}

    def count(batches):
        hashed = {lang: _hash_names(names) for lang, names in wanted.items()}
        order = {lang: np.argsort(h) for lang, h in hashed.items()}
        sums: dict[str | None, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for first, last, data, offsets in text_blocks(batch.column(1)):
                words = find_words(data, offsets)
                hashes, _, _ = plain_words(words)
                classes = class_counts(data, offsets)
                for lang, texts, which in _by_language(langs[first:last], words):
                    known = hashed.get(lang, np.zeros(0, np.uint64))
                    mine = np.concatenate((classes[texts].sum(axis=0), [len(which)], np.zeros(len(known), np.int64)))
                    if len(known):
                        ranked = known[order[lang]]
                        at = np.minimum(np.searchsorted(ranked, hashes[which]), len(known) - 1)
                        hit = ranked[at] == hashes[which]
                        mine[9:] = np.bincount(order[lang][at[hit]], minlength=len(known))
                    sums[lang] = sums[lang] + mine if lang in sums else mine
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([x.tolist() for x in sums.values()], pa.list_(pa.int64()))], ["lang", "counts"]
        )

    rows = documents.select("lang", "text").mapInArrow(count, "lang string, counts array<long>")
    rows = rows.select("lang", F.posexplode("counts").alias("place", "n")).groupBy("lang", "place").agg(F.sum("n").alias("n"))
    gathered: dict[str | None, dict[int, int]] = {}
    for lang, place, n in rows.collect():
        gathered.setdefault(lang, {})[place] = n
    out = {}
    for lang, counts in gathered.items():
        names = wanted.get(lang, [])
        ranked = sorted(range(len(names)), key=lambda k: (-counts[9 + k], names[k]))[:common]
        n = np.array([counts[9 + k] for k in ranked], np.int64)
        if counts[8] >= LEAST_REFERENCE_WORDS:
            out[lang] = (
                np.array([counts[k] for k in range(8)], np.int64),
                _hash_names([names[k] for k in ranked]),
                np.append(n, counts[8] - n.sum()),
            )
    return out


def _hash_names(names: list[str]) -> np.ndarray:
    data = [x.encode() for x in names]
    ends = np.cumsum([len(x) for x in data]).astype(np.int64)
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64) if len(ends) else ends
    return Words(np.frombuffer(b"".join(data), np.uint8), starts, ends, starts, starts, starts).hashes()


def judged(documents: DataFrame, class_limit: float = MOST_CLASS_DISTANCE, word_limit: float = MOST_WORD_DISTANCE) -> DataFrame:
    """doc_id, the basic counts, base_failed, both distances (six decimals) and kept, row by row.

    A document fails the base rules if it has under 50 words or if over half of its words stand
    in repeated windows. One that passes is kept if both distances are within their limits. The
    distances are null for texts of fewer than `LEAST_COMPARED_WORDS` words and for languages of
    fewer than `LEAST_REFERENCE_WORDS`; a null distance rejects nothing. Null is a language of its
    own. A null or empty text has zero counts and fails the base rules. Equal rows get equal
    results; a null doc_id is passed on; other columns are ignored; an empty table gives an
    empty result.
    """
    known = references(documents)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance"]

    def judge(batches):
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for first, last, data, offsets in text_blocks(batch.column(2)):
                words = find_words(data, offsets)
                counts = basic_counts(data, offsets, words)
                hashes, _, _ = plain_words(words)
                classes = class_counts(data, offsets)
                far = np.full((2, last - first), np.nan)
                for lang, texts, which in _by_language(langs[first:last], words):
                    if lang not in known:
                        continue
                    class_counts_known, common, word_counts = known[lang]
                    order = np.argsort(common)
                    bins = np.full(len(which), len(common))
                    if len(common):
                        at = np.minimum(np.searchsorted(common[order], hashes[which]), len(common) - 1)
                        hit = common[order][at] == hashes[which]
                        bins[hit] = order[at[hit]]
                    width = len(common) + 1
                    rows = np.bincount(words.text[which] * width + bins, minlength=width * (last - first)).reshape(-1, width)[texts]
                    long_enough = words.counts[texts] >= LEAST_COMPARED_WORDS
                    far[0, texts] = np.where(long_enough, distance(classes[texts], class_counts_known), np.nan)
                    far[1, texts] = np.where(long_enough, distance(rows, word_counts), np.nan)
                arrays = [batch.column(0).slice(first, last - first)] + [pa.array(counts[n]) for n in names[1:6]]
                arrays += [pa.array(np.round(x, 6), from_pandas=True) for x in far]
                yield pa.RecordBatch.from_arrays(arrays, names)

    rows = documents.select("doc_id", "lang", "text").mapInArrow(
        judge, "doc_id long, " + ", ".join(f"{n} long" for n in names[1:6]) + ", class_distance double, word_distance double"
    )
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    far = (F.col("class_distance") > class_limit) | (F.col("word_distance") > word_limit)
    return rows.withColumn("base_failed", base_failed).withColumn("kept", ~base_failed & ~F.coalesce(far, F.lit(False)))
