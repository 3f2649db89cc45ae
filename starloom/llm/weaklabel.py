"""A quality classifier without hand labels.

Overlapping heuristic labellers vote good, bad or nothing on every document.
Expectation-maximisation estimates how each labeller votes on good and on bad documents from how
the votes agree, and so gives each document a probability of being good. These posteriors train a
linear scorer on hashed features, which judges every document.

Abuse is a second head: a text may be well written and abusive. Its labeller votes with the others,
and its bad votes alone can reject a document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import text_blocks
from starloom.llm.divergence import basic_counts
from starloom.llm.words import LOWER, Words, find_words, mix

LABELLERS = ("symbols", "capitals", "repeated_words", "bare_marks", "exclamations", "sentences", "word_length", "repeated_lines", "clean", "abuse")
GOOD, BAD, NONE = 1, 2, 0
ROUNDS = 200
#: Documents that train the scorer: those whose ids have the smallest hashes.
TRAINED_ON = 6000
FEATURE_BITS = 14
STEPS = 300
RATE = 4.0
DECAY = 1e-4
LEAST_SCORE = 0.4
#: Words that are insults wherever they stand. Every list is looked up in every text, as `lang` may
#: be missing or wrong; so words that are harmless in another of the languages are not listed.
INSULTS = {
    "en": "idiot idiots moron morons stupid scum scumbag imbecile cretin dimwit dumbass asshole bitch bastard retard",
    "de": "idiot idioten trottel vollidiot depp dummkopf arschloch wichser hurensohn schlampe missgeburt drecksau abschaum",
    "fr": "idiote crétin crétine abruti abrutie imbécile connard connasse salaud salope enculé débile",
    "es": "idiota idiotas imbécil estúpido estúpida gilipollas pendejo cabrón puta subnormal escoria",
}
#: Words that insult or describe: without one of the above, two different ones make abuse.
SLIGHTS = {
    "en": "trash pathetic disgusting worthless clown clowns loser losers",
    "de": "erbärmlich widerlich wertlos versager",
    "fr": "pitoyable dégoûtant minable clown",
    "es": "patético asqueroso inútil payaso basura",
}
#: Share of all words of a text that makes it abusive; a quoted insult in a longer text does not.
ABUSE_RATE = 0.01

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[0xC0:] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_BANG = np.zeros(256, bool)
_BANG[ord("!")] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True


def _in_words(flags: np.ndarray, words: Words) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[words.ends] - sums[words.starts]


def _per_text(values: np.ndarray, words: Words) -> np.ndarray:
    return np.bincount(words.text, weights=values, minlength=len(words.counts))


def _spelled(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words in lower case, without punctuation and digits."""
    low = LOWER[data]
    low[(low < 0x80) & ~_LETTER[low]] = 32
    accented = np.concatenate(([False], data[:-1] == 0xC3)) & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    low[accented] += 32
    return find_words(low, offsets)


def _lexicon(lists: dict[str, str]) -> np.ndarray:
    data = " ".join(lists.values()).encode()
    return np.unique(find_words(np.frombuffer(data, np.uint8), np.array([0, len(data)])).hashes())


_INSULTS, _SLIGHTS = _lexicon(INSULTS), _lexicon(SLIGHTS)


def abusive(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts of which insulting words are a share of `ABUSE_RATE`."""
    words = _spelled(data, offsets)
    hashes = words.hashes()
    insult, slight = np.isin(hashes, _INSULTS), np.isin(hashes, _SLIGHTS)
    rate = _per_text(insult | slight, words) / np.maximum(words.counts, 1)
    pairs = np.unique(np.stack([words.text[slight].astype(np.uint64), hashes[slight]], axis=1), axis=0)
    kinds = np.bincount(pairs[:, 0].astype(np.int64), minlength=len(words.counts))
    return (rate >= ABUSE_RATE) & ((_per_text(insult, words) > 0) | (kinds > 1))


def votes(data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """One row a text, one column a labeller. A text without words gets none.

    Most labellers know one fault and are silent otherwise, as a text without this fault may have
    another."""
    counts = basic_counts(data, offsets, words)
    n = np.maximum(words.counts, 1)
    letters = _in_words(_LETTER[data], words)
    capitals = _in_words(_UPPER[data], words)
    upper = _per_text((capitals >= 2) & (capitals >= letters - _in_words(data >= 0xC0, words)), words) / n
    bare = _per_text(letters == 0, words) / n
    bangs = _per_text(_BANG[data[words.ends - 1]] if len(words.ends) else np.zeros(0), words) / n
    stops = _per_text(_STOP[data[words.ends - 1]] if len(words.ends) else np.zeros(0), words) / n
    lines = np.bincount(np.searchsorted(offsets, np.flatnonzero(data == 10), "right") - 1, minlength=len(n)) + 1
    length = counts["word_chars"] / n
    marks, repeats, doubled = counts["n_symbols"] / n, counts["n_repeat_words"] / n, counts["n_dup_lines"] / lines
    clean = (marks < 0.02) & (upper < 0.1) & (repeats < 0.15) & (bare < 0.02) & (bangs < 0.02) & (doubled < 0.2)
    out = np.stack(
        [
            np.where(marks >= 0.15, BAD, NONE),
            np.where(upper >= 0.3, BAD, NONE),
            np.where(repeats >= 0.35, BAD, NONE),
            np.where(bare >= 0.1, BAD, NONE),
            np.where(bangs >= 0.15, BAD, NONE),
            np.where((stops >= 0.02) & (stops <= 0.3), GOOD, np.where((n >= 30) & (stops < 0.005), BAD, NONE)),
            np.where((length < 2.5) | (length > 12), BAD, NONE),
            np.where((lines >= 4) & (doubled >= 0.3), BAD, NONE),
            np.where(clean, GOOD, NONE),
            np.where(abusive(data, offsets), BAD, NONE),
        ],
        axis=1,
    ).astype(np.int8)
    out[words.counts == 0] = NONE
    return out


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over distinct vote patterns.

    Returns the probability of good for each pattern, and for each labeller and class (good, bad)
    the probabilities of its votes (nothing, good, bad). The start takes every labeller to be
    right in seven votes of eight. Votes are smoothed by one document each.
    """
    one_hot = patterns[:, :, None] == np.arange(3)
    right = np.array([[0.6, 0.35, 0.05], [0.6, 0.05, 0.35]])
    rates = np.tile(right, (patterns.shape[1], 1, 1))
    share = 0.8
    posterior = np.zeros(len(patterns))
    for _ in range(rounds):
        likely = np.einsum("plv,lcv->pc", one_hot, np.log(rates)) + np.log([share, 1 - share])
        likely = np.exp(likely - likely.max(axis=1, keepdims=True))
        posterior = likely[:, 0] / likely.sum(axis=1)
        weight = np.stack([posterior, 1 - posterior], axis=1) * counts[:, None]
        rates = np.einsum("pc,plv->lcv", weight, one_hot) + 1.0
        rates /= rates.sum(axis=2, keepdims=True)
        share = float(np.clip(weight[:, 0].sum() / max(counts.sum(), 1), 0.01, 0.99))
    return posterior, rates


def features(data: np.ndarray, offsets: np.ndarray, words: Words, bits: int = FEATURE_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: text, feature and value. Features are words and word shapes, hashed; values
    are damped counts, of length one for each text."""
    if not len(words.starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    size = words.ends - words.starts
    upper, letters = _in_words(_UPPER[data], words), _in_words(_LETTER[data], words)
    symbols = _in_words(_SYMBOL[data], words)
    last = data[words.ends - 1]
    shape = (
        np.minimum(size, 15)
        + 16 * np.minimum(symbols, 3)
        + 64 * np.where(upper == 0, 0, np.where(upper == letters, 2, 1))
        + 256 * (letters == 0)
        + 512 * np.where(_LETTER[last] | (last >= 0x80), 0, 1 + last.astype(np.int64))
    )
    same = np.zeros(len(size), np.int64)
    hashes = words.hashes()
    same[1:] = (hashes[1:] == hashes[:-1]) & (words.text[1:] == words.text[:-1])
    repeats = mix((same + 7).astype(np.uint64))
    keys = np.concatenate((hashes, mix(shape.astype(np.uint64) + np.uint64(1 << 40)), repeats)) >> np.uint64(64 - bits)
    text = np.tile(words.text, 3)
    found, counts = np.unique((text << bits) + keys.astype(np.int64), return_counts=True)
    row, feature = found >> bits, found & ((1 << bits) - 1)
    value = np.log1p(counts)
    norm = np.sqrt(np.bincount(row, weights=value * value, minlength=len(words.counts)))
    return row, feature, value / norm[row]


def fit_scorer(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, target: np.ndarray, bits: int = FEATURE_BITS) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by gradient steps over all rows."""
    weights, bias = np.zeros(1 << bits), 0.0
    count = max(len(target), 1)
    for _ in range(STEPS):
        score = np.bincount(rows, weights=values * weights[columns], minlength=len(target)) + bias
        error = 1 / (1 + np.exp(-score)) - target
        weights -= RATE * (np.bincount(columns, weights=values * error[rows], minlength=1 << bits) / count + DECAY * weights)
        bias -= RATE * error.sum() / count
    return weights, bias


def _voted(documents: DataFrame) -> DataFrame:
    def vote(batches):
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(1)):
                rows = votes(data, offsets, find_words(data, offsets))
                pattern = (rows.astype(np.int64) * 3 ** np.arange(rows.shape[1])).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(pattern)], ["doc_id", "pattern"])

    return documents.select("doc_id", "text").mapInArrow(vote, "doc_id long, pattern long")


def unfold(pattern: np.ndarray) -> np.ndarray:
    return (pattern[:, None] // 3 ** np.arange(len(LABELLERS))) % 3


class Classifier:
    """The fitted model: posteriors of the vote patterns, and the scorer."""

    def __init__(self, posteriors: dict[int, float], weights, bias: float):
        self.posteriors, self.weights, self.bias = posteriors, weights, bias


def _patterns(rows: np.ndarray) -> np.ndarray:
    return (rows.astype(np.int64) * 3 ** np.arange(len(LABELLERS))).sum(axis=1)


def _scores(data: np.ndarray, offsets: np.ndarray, words: Words, weights: np.ndarray, bias: float) -> np.ndarray:
    row, column, value = features(data, offsets, words)
    score = np.bincount(row, weights=value * weights[column], minlength=len(words.counts)) + bias
    return np.round(np.where(words.counts > 0, 1 / (1 + np.exp(-score)), 0.0), 6)


def fitted(documents: DataFrame, trained_on: int = TRAINED_ON) -> Classifier:
    """Votes of all documents, estimation over their patterns, and the scorer from a sample."""
    counted = sorted(_voted(documents).groupBy("pattern").count().collect())  # 3 to the power of 10 at most
    patterns = np.array([r[0] for r in counted], np.int64)
    posterior, _ = fit_votes(unfold(patterns), np.array([r[1] for r in counted], np.float64)) if counted else (np.zeros(0), None)
    known = dict(zip(patterns.tolist(), posterior.tolist()))

    chosen = documents.where("doc_id is not null").select("doc_id").distinct()
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(trained_on)
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi")
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"))  # one row an id, however many have it

    def describe(batches):
        names = ["doc_id", "target", "columns", "values"]
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(1)):
                words = find_words(data, offsets)
                pattern = _patterns(votes(data, offsets, words))
                row, column, value = features(data, offsets, words)
                cuts = np.searchsorted(row, np.arange(last - first + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array([known[p] for p in pattern.tolist()], pa.float64()),
                        pa.array([column[a:b].astype(np.int16).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                        pa.array([value[a:b].astype(np.float32).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    ],
                    names,
                )

    trained = sample.mapInArrow(describe, "doc_id long, target double, columns binary, values binary")
    rows = sorted((r.doc_id, bytes(r.columns), bytes(r["values"]), r.target) for r in trained.collect())
    weights, bias = np.zeros(1 << FEATURE_BITS), 0.0
    if rows:
        columns = [np.frombuffer(r[1], np.int16) for r in rows]
        values = [np.frombuffer(r[2], np.float32) for r in rows]
        index = np.repeat(np.arange(len(rows)), [len(c) for c in columns])
        weights, bias = fit_scorer(
            index, np.concatenate(columns).astype(np.int64), np.concatenate(values).astype(np.float64), np.array([r[3] for r in rows])
        )
    return Classifier(known, documents.sparkSession.sparkContext.broadcast(weights), bias)  # 2^14 numbers


def classified(
    documents: DataFrame, trained_on: int = TRAINED_ON, least_score: float = LEAST_SCORE, reject_abuse: bool = False
) -> DataFrame:
    """doc_id, votes (text, one letter a labeller), posterior, score and kept for each row.

    All documents vote, and the estimation uses the counts of all distinct vote patterns, at most
    3 to the power of 10. The scorer is fitted on the `trained_on` documents whose ids have the
    smallest hashes, a bounded sample, and applied to all. Posterior and score have six decimals.

    A null or empty text, or one without words, scores 0 and is rejected. Rows without a doc_id
    vote and are judged, but do not train; rows that share a doc_id may all train. Equal texts
    get equal scores. Other columns are ignored. An empty table gives an empty result.

    `kept` is the verdict on the writing; with `reject_abuse`, abusive texts are not kept either.
    """
    model = fitted(documents, trained_on)

    def judge(batches):
        names = ["doc_id", "votes", "posterior", "score"]
        letters = np.array(["-", "g", "b"])
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(1)):
                words = find_words(data, offsets)
                rows = votes(data, offsets, words)
                posterior = [model.posteriors[p] for p in _patterns(rows).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(["".join(x) for x in letters[rows].tolist()], pa.string()),
                        pa.array(np.round(np.array(posterior, np.float64), 6)),
                        pa.array(_scores(data, offsets, words, model.weights.value, model.bias)),
                    ],
                    names,
                )

    judged = documents.select("doc_id", "text").mapInArrow(judge, "doc_id long, votes string, posterior double, score double")
    kept = F.col("score") >= least_score
    if reject_abuse:
        kept = kept & (F.substring("votes", LABELLERS.index("abuse") + 1, 1) != "b")
    return judged.withColumn("kept", kept)


def accepted(
    documents: DataFrame, trained_on: int = TRAINED_ON, least_score: float = LEAST_SCORE, reject_abuse: bool = False
) -> DataFrame:
    """The rows of `documents` that `classified` keeps, with all columns and without a shuffle."""
    model = fitted(documents, trained_on)
    place = documents.columns.index("text")

    def choose(batches):
        for batch in batches:
            keep = [np.zeros(0, bool)]
            for _, _, data, offsets in text_blocks(batch.column(place)):
                score = _scores(data, offsets, find_words(data, offsets), model.weights.value, model.bias)
                keep.append((score >= least_score) & ~abusive(data, offsets) if reject_abuse else score >= least_score)
            yield batch.filter(pa.array(np.concatenate(keep)))

    return documents.mapInArrow(choose, documents.schema)
