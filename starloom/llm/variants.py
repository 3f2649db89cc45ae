"""Spelling variants: words that one edit parts, found by range search over letter counts.

Words are points of k-d trees, a tree for each length. A word is looked up in the tree of its
length, where a changed letter takes one from a count and adds one to another, and in the tree of
the next smaller length, where a letter left out takes one from a count. In the leaves that the
search reaches, vectors at just that difference are found, and then the order of the letters is
checked: the edit is made in the word and the result looked up among the leaf's words.

The upper part of each tree is fitted to a sample of the words and cuts them into cells. A cell
is a task's index, whose words look up all words that may reach the cell, a batch at a time.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import few_rows, written
from starloom.llm.kdtree import LETTERS, Tree, count_vectors, letters_of
from starloom.llm.words import mix, seeded

LEAST_LETTERS = 5
LEAST_COUNT = 3
RATIO = 2
#: About so many words, those of the highest hashes, the upper trees are fitted to.
SAMPLE = 1 << 17
#: A cell holds about so many words at most, and at least; between the two, there are four a core.
CELL_WORDS, SMALL_CELL_WORDS = 1 << 15, 1 << 11
HELD_WORDS = 200_000
BATCH = 4096
POINT, SAME, LONGER = 0, 1, 2
NEAR = "word string, n_near long, other_n long, other string"


def _slipped(word: str, drawn: int) -> str:
    at = drawn % len(word)
    return word[:at] + word[at + 1 :]


def vocabulary(
    documents: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, slip_one_in: int | None = None
) -> DataFrame:
    """word and n: runs of Latin letters, A-Z in lower case, with how often they occur in all.

    With `slip_one_in` a word of a document whose checksum this number divides loses a letter in
    all its places there, as a slip of the pen; rows without a doc_id have none. Tasks add up
    counts before they send them, so a frequent word costs no more than another. A null text has
    no words; repeated rows count as often as they are there; other columns are left out.
    """
    pattern = re.compile(f"[a-zÀ-ÿ]{{{least_letters},}}")

    def sent(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in few_rows(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # bytes.lower() changes A-Z only
                found = Counter(pattern.findall((text or "").encode().lower().decode()))
                if slip_one_in and doc is not None:
                    lead = zlib.crc32(f"{doc}:".encode())
                    for word in list(found):
                        drawn = zlib.crc32(word.encode(), lead)
                        if drawn % slip_one_in == 0:
                            n = found.pop(word)
                            total[_slipped(word, drawn)] += n
                total.update(found)
                if len(total) >= HELD_WORDS:
                    yield sent(total)
                    total = Counter()
        yield sent(total)

    counted = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "word string, n long")
    words = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return words.where((F.col("n") >= least_count) & (F.length("word") >= least_letters))


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, row numbers and letters of the words of each length."""
    rows = defaultdict(list)
    for row, word in enumerate(words):
        rows[len(word)].append(row)
    for length, some in sorted(rows.items()):
        yield length, np.array(some), letters_of([words[row] for row in some])


class Cells:
    """The upper trees, and the numbers of their leaves that hold words."""

    def __init__(self, sample: list[str], share: float, cell_words: int):
        leaf = max(int(cell_words * share), 1)
        self.cell_words = cell_words
        self.trees = {length: Tree(count_vectors(letters), leaf) for length, _, letters in _by_length(sample)}
        for tree in self.trees.values():
            tree.members = []
        self.numbers: dict[tuple[int, int], tuple[int, int]] = {}
        self.tasks: list[int] = []

    def home(self, length: int, vectors: np.ndarray) -> np.ndarray:
        return self.trees[length].leaf_of(vectors) if length in self.trees else np.zeros(len(vectors), np.int64)

    def reach(self, length: int, vectors: np.ndarray, gain: int, lose: int) -> tuple[np.ndarray, np.ndarray]:
        if length in self.trees:
            return self.trees[length].search(vectors, gain, lose)
        return np.arange(len(vectors)), np.zeros(len(vectors), np.int64)

    def number(self, counts: list[tuple[int, int, int]]) -> None:
        """Takes the words in each (length, leaf). A leaf that holds too many, as its vectors are
        equal or the sample said otherwise, is parted by a hash of the word. Small ones share
        a task."""
        before = 0
        for length, leaf, n in sorted(counts):
            parts = -(-n // (2 * self.cell_words))
            self.numbers[length, leaf] = len(self.tasks), parts
            for part in range(parts):
                self.tasks.append(before // self.cell_words)
                before += n // parts


def _homes(words: DataFrame, cells: Cells) -> list[tuple[int, int, int]]:
    """Words in each leaf: as many rows as leaves, which the sample bounds, and other lengths."""

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches, BATCH):
            for length, rows, letters in _by_length(batch.column(0).to_pylist()):
                leaf, n = np.unique(cells.home(length, count_vectors(letters)), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(leaf), length), pa.int64()), pa.array(leaf, pa.int64()), pa.array(n, pa.int64())], ["length", "leaf", "n"]
                )

    counts = words.select("word").mapInArrow(homes, "length long, leaf long, n long")
    return [tuple(row) for row in counts.groupBy("length", "leaf").agg(F.sum("n")).collect()]


def _routed(words: DataFrame, cells: Cells) -> DataFrame:
    """Each word once as a point of its cell, and once for each cell it may have near words in."""

    task_of = np.array(cells.tasks, np.int32)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches, BATCH):
            texts, n = batch.column(0).to_pylist(), batch.column(1)
            out: list[tuple[np.ndarray, np.ndarray, int]] = []

            def send(rows: np.ndarray, length: int, leaf: np.ndarray, kind: int) -> None:
                for of in np.unique(leaf).tolist():
                    if (length, of) in cells.numbers:
                        first, parts = cells.numbers[length, of]
                        some = rows[leaf == of]
                        if kind == POINT:
                            part = np.array([zlib.crc32(texts[row].encode()) % parts for row in some.tolist()])
                            out.append((some, first + part, kind))
                        else:
                            out.extend((some, np.full(len(some), first + part), kind) for part in range(parts))

            for length, rows, letters in _by_length(texts):
                vectors = count_vectors(letters)
                send(rows, length, cells.home(length, vectors), POINT)
                row, leaf = cells.reach(length, vectors, 1, 1)
                send(rows[row], length, leaf, SAME)
                row, leaf = cells.reach(length - 1, vectors, 0, 1)
                send(rows[row], length - 1, leaf, LONGER)
            row = np.concatenate([some for some, _, _ in out])
            cell = np.concatenate([some for _, some, _ in out])
            kind = np.concatenate([np.full(len(some), kind) for some, _, kind in out])
            yield pa.RecordBatch.from_arrays(
                [pa.array(task_of[cell]), pa.array(cell, pa.int32()), pa.array(kind, pa.int8()), batch.column(0).take(pa.array(row)), n.take(pa.array(row))],
                ["task", "cell", "kind", "word", "n"],
            )

    return words.mapInArrow(route, "task int, cell int, kind byte, word string, n long")


class Index:
    """The words of a cell by their letters and by their letter counts."""

    def __init__(self, words: list[str], n: list[int]):
        order = sorted(range(len(words)), key=words.__getitem__)
        self.words = [words[k] for k in order]
        self.n = np.array(n, np.int64)[order]
        self.letters = letters_of(self.words)
        self.length = self.letters.shape[1]
        vectors = count_vectors(self.letters)
        self._draw(0)
        vector, first = np.unique(vectors @ self.weights, return_index=True)
        self.vector, self.tree = vector, Tree(vectors[first])

    def _draw(self, seed: int) -> None:
        """Draws values for letters and places until no two words have the same sum."""
        drawn = seeded(f"letters {seed}", 256 + len(LETTERS))
        self.values, self.weights = drawn[:256], drawn[256:].view(np.int64)
        self.base = int(seeded(f"base {seed}", 1)[0]) | 1
        self.powers = np.array([pow(self.base, k, 1 << 64) for k in range(self.length + 2)], np.uint64)
        sums = (self.values[self.letters] * self.powers[: self.length]).sum(axis=1, dtype=np.uint64)
        self.order = np.argsort(sums)
        self.sums = sums[self.order]
        if (self.sums[1:] == self.sums[:-1]).any():
            self._draw(seed + 1)

    def near(self, letters: np.ndarray, longer: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, word) one edit apart: a letter of the row changed into a later one of
        LETTERS, or with `longer` left out. Each pair shows once."""
        vectors = count_vectors(letters)
        distinct, first, of = np.unique(vectors @ self.weights, return_index=True, return_inverse=True)
        row, leaf = self.tree.search(vectors[first], 0 if longer else 1, 1)
        # the vectors of the leaves that are at the very difference of one edit
        sizes = np.array([len(some) for some in self.tree.members])
        flat, starts = np.concatenate(self.tree.members), np.cumsum(sizes) - sizes
        times = sizes[leaf]
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        row, other = np.repeat(row, times), flat[np.repeat(starts[leaf], times) + step]
        lost, gained = np.triu_indices(len(LETTERS), 1) if not longer else (np.arange(len(LETTERS)),) * 2
        edits = -self.weights[lost] + (0 if longer else self.weights[gained])
        rank = np.argsort(edits)
        edits = edits[rank]
        apart = self.vector[other] - distinct[row]
        at = np.minimum(np.searchsorted(edits, apart), len(edits) - 1)
        hit = edits[at] == apart
        row, edit = row[hit], rank[at[hit]]
        # all words of these vectors, with the edit made at each place of the letter
        by_vector = np.argsort(of, kind="stable")
        sizes = np.bincount(of, minlength=len(distinct))
        starts = np.cumsum(sizes) - sizes
        found = []
        for low in range(0, len(row), BATCH):
            some, e = row[low : low + BATCH], edit[low : low + BATCH]
            times = sizes[some]
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            found.append(self._edited(letters, by_vector[np.repeat(starts[some], times) + step], LETTERS[lost[np.repeat(e, times)]], LETTERS[gained[np.repeat(e, times)]], longer))
        rows, others = zip(*found) if found else ([np.zeros(0, np.int64)],) * 2
        return np.concatenate(rows), np.concatenate(others)

    def _edited(self, letters: np.ndarray, row: np.ndarray, lost: np.ndarray, gained: np.ndarray, longer: bool) -> tuple[np.ndarray, np.ndarray]:
        pair, place = np.nonzero(letters[row] == lost[:, None])
        row, lost, gained = row[pair], lost[pair], gained[pair]
        if longer:  # of equal letters side by side the last one goes
            after = letters[row, np.minimum(place + 1, letters.shape[1] - 1)]
            last = (place + 1 == letters.shape[1]) | (after != lost)
            row, place, lost, gained = row[last], place[last], lost[last], gained[last]
            made = np.where(np.arange(self.length) < place[:, None], letters[row, :-1], letters[row, 1:])
        else:
            made = letters[row]
            made[np.arange(len(row)), place] = gained
        sums = (self.values[made] * self.powers[: self.length]).sum(axis=1, dtype=np.uint64)
        at = np.minimum(np.searchsorted(self.sums, sums), len(self.sums) - 1)
        word = self.order[at]
        same = self.sums[at] == sums
        same[same] = (made[same] == self.letters[word[same]]).all(axis=1)
        return row[same], word[same]


def _summed(of: np.ndarray, words: list[str], n: np.ndarray, other: np.ndarray, others: list[str], tie: np.ndarray) -> pa.RecordBatch:
    """Per word the number of its near words in a batch, and the most frequent of them."""
    order = np.lexsort((tie[other], -n[other], of))
    first = np.flatnonzero(np.diff(of[order], prepend=-1))
    counts = np.diff(np.append(first, len(order)))
    word, best = of[order][first], other[order][first]
    columns = [[words[k] for k in word.tolist()], counts, n[best], [others[k] for k in best.tolist()]]
    types = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["word", "n_near", "other_n", "other"])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of each cell, whose rows come points first."""
    cell, words, n, index = None, [], [], None
    for batch in few_rows(batches, BATCH):
        cells, kinds = batch.column("cell").to_numpy(), batch.column("kind").to_numpy()
        edges = np.flatnonzero((np.diff(cells) != 0) | (np.diff(kinds) != 0)) + 1
        for first, last in zip([0, *edges], [*edges, len(cells)]):
            some, some_n = batch.column("word")[first:last].to_pylist(), batch.column("n")[first:last].to_numpy()
            if cells[first] != cell:
                cell, words, n, index = cells[first], [], [], None
            if kinds[first] == POINT:
                words += some
                n += some_n.tolist()
                continue
            if not words:  # a part that the hash has left without points
                continue
            index = index or Index(words, n)
            row, other = index.near(letters_of(some), kinds[first] == LONGER)
            if len(row):
                yield _summed(row, some, index.n, other, index.words, np.arange(len(index.words)))
                tie = np.argsort(np.argsort(np.array(some, dtype=object), kind="stable"), kind="stable")
                yield _summed(other, index.words, some_n, row, some, tie)


def near_words(words: DataFrame, sample: int = SAMPLE, cell_words: int | None = None) -> DataFrame:
    """word, n_near and the most frequent near word (other, other_n) of each word that has one.

    `words` has distinct words of Latin letters and their counts n. Two words are near if one
    letter that is changed, added or left out parts them. Of equally frequent ones the first in
    code-point order counts.
    """
    count = words.count()
    least = int(2**63 * (1 - 2 * min(sample / max(count, 1), 1)))  # as many hashes are as high as the sample is large
    some = words.select("word").where(F.xxhash64("word") >= least).collect()  # about `sample` rows
    if cell_words is None:
        cores = words.sparkSession.sparkContext.defaultParallelism
        cell_words = min(max(count // (4 * cores), SMALL_CELL_WORDS), CELL_WORDS)
    cells = Cells([row.word for row in some], len(some) / max(count, 1), cell_words)
    cells.number(_homes(words, cells))
    tasks = cells.tasks[-1] + 1 if cells.tasks else 1
    routed = _routed(words, cells).repartition(tasks, "task").sortWithinPartitions("cell", "kind")
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best")
    found = routed.mapInArrow(_found, NEAR).groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("best.minus")).alias("other_n"), F.col("best.other").alias("other"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root: where following the forms (word, form) from a word ends.

    Each round doubles the way that every word has gone, so the rounds grow with the logarithm of
    the longest chain. A form must never lead back to its word.
    """
    ways = written(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        on = ways.select(F.col("word").alias("via"), F.col("root").alias("next"))
        further = ways.join(on, F.col("root") == F.col("via"), "left")
        if not further.where("next is not null").limit(1).count():
            return ways
        ways = written(further.select("word", F.coalesce("next", "root").alias("root")), "ways")


def grouped(words: DataFrame, ratio: int = RATIO, sample: int = SAMPLE, cell_words: int | None = None) -> DataFrame:
    """word, form, root, n, n_near and form_n for the words and counts (word, n).

    A word's form is its most frequent near word if that is `ratio` times as frequent at least;
    the root is what following the forms leads to. An empty table gives an empty result.
    """
    words = written(words.select("word", "n"), "vocabulary")
    near = near_words(words, sample, cell_words)
    has_form = F.col("other_n") >= ratio * F.col("n")
    judged = written(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(has_form, F.col("other")).alias("form"), F.when(has_form, F.col("other_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
