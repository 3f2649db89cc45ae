"""Packing documents into sequences of a fixed number of tokens.

How pieces are packed depends on their lengths only, and there are no more lengths than the
capacity. So the tasks count pieces by length, the driver packs this histogram, a whole stretch
of equal pieces at a time, and the tasks look up where the k-th piece of a length goes.

Lengths above a third of the capacity go two to a sequence at most: from the longest down, each
is matched with the longest that still fits. Shorter lengths go, from the longest down, into the
fullest sequences that have room for them (best fit), and only then into new ones.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import few_rows, written

CAPACITY = 2048
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
END = 0
SLICE_CHARS = 1 << 20
#: Up to here the two libraries split texts alike, which a test holds them to.
LAST_ALIKE = "ɏ"
PIECES = "doc_id long, piece int, start long, length long, ids binary, lane int, place long"


class Encoder:
    """Ids of texts as `tokenizers` gives them.

    Texts of Latin letters go by the same vocabulary's ranks in `tiktoken`, which gives the same
    ids in a quarter of the time; all others, and those that may spell a special token, go to
    `tokenizers` itself. Long texts are encoded in slices that end before a single blank, where
    every token ends.
    """

    def __init__(self, vocabulary: str = VOCABULARY, ranks: str = RANKS):
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks, "rb") as file:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.exact = Tokenizer.from_file(vocabulary)
        self.quick = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={}
        )

    def ids(self, text: str) -> np.ndarray:
        parts = [self._slice(part) for part in slices(text)]
        return np.concatenate([*parts, [END]]).astype("<u4")

    def _slice(self, text: str) -> list[int]:
        if text.isascii() or max(text) <= LAST_ALIKE:
            if "<|" not in text:
                return self.quick.encode_ordinary(text)
        return self.exact.encode(text, add_special_tokens=False).ids


def slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """Parts of about `size`, each but the first led by a blank between two other characters."""
    first = 0
    while len(text) - first > size:
        cut = text.find(" ", first + size)
        while cut > 0 and (text[cut - 1].isspace() or text[cut + 1 : cut + 2].isspace()):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[first:cut]
        first = cut
    if first < len(text):
        yield text[first:]


def pieces(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, ranks: str = RANKS) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian, 32 bits each), lane and place.

    A document is its ids and the id 0 at the end. One that is longer than the capacity is cut;
    its first piece takes what is over. A null or empty text is the one id 0. Each row is a
    document of its own, whatever its doc_id. `place` numbers the pieces of a length within a
    lane, which is the task that made them: write the pieces out before using them twice.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, ranks)
        lane, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in few_rows(batches):
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.ids(text or "")
                ends = range(len(ids) % capacity or capacity, len(ids) + 1, capacity) if len(ids) > capacity else [len(ids)]
                start = 0
                for piece, end in enumerate(ends):
                    out.append((doc, piece, start, end - start, ids[start:end].tobytes(), lane, seen[end - start]))
                    seen[end - start] += 1
                    start = end
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids", "lane", "place")
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


class Plan:
    """Where the pieces of a histogram go.

    A row says: from rank `first` on, pieces of `length` fill the `bins` sequences from `bin` on,
    `copies` to each, from `offset` on. Every row but the last of its length uses up a stretch of
    equally filled sequences, so their number depends on the capacity, not on the pieces.
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.used = capacity, 0
        self.left = np.zeros(capacity + 1, np.int64)
        for length, count in counts.items():
            self.left[length] = count
        self.rank = np.zeros(capacity + 1, np.int64)
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self._match_large()
        for length in range(capacity // 3, 0, -1):
            self._best_fit(length)

    def _put(self, length: int, copies: int, first: int, bins: int, gap: int) -> None:
        """`copies` of a length into each of some sequences that have `gap` left."""
        if bins:
            self.rows.append((length, self.rank[length], copies, first, bins, self.capacity - gap))
            self.rank[length] += copies * bins
            self.left[length] -= copies * bins
            if gap - copies * length:
                self.gaps[gap - copies * length].append((first, bins))

    def _new(self, bins: int) -> int:
        self.used += bins
        return self.used - bins

    def _match_large(self) -> None:
        least = self.capacity // 3 + 1
        for length in range(self.capacity, least - 1, -1):
            other = min(length, self.capacity - length)
            while self.left[length] and other >= least:
                bins = int(self.left[length] // 2 if other == length else min(self.left[length], self.left[other]))
                if bins:
                    first = self._new(bins)
                    self._put(length, 1, first, bins, self.capacity)
                    self.gaps[self.capacity - length].pop()
                    self._put(other, 1, first, bins, self.capacity - length)
                other -= 1
            bins = int(self.left[length])
            self._put(length, 1, self._new(bins), bins, self.capacity)

    def _best_fit(self, length: int) -> None:
        for gap in sorted(g for g in self.gaps if g >= length):
            waiting, self.gaps[gap] = self.gaps[gap], []
            for first, bins in waiting:
                full = min(bins, int(self.left[length]) // (gap // length))
                self._put(length, gap // length, first, full, gap)
                if full < bins and self.left[length]:
                    self._put(length, int(self.left[length]), first + full, 1, gap)
                    full += 1
                if full < bins:
                    self.gaps[gap].append((first + full, bins - full))
            if not self.left[length]:
                return
        copies = self.capacity // length
        full = int(self.left[length]) // copies
        self._put(length, copies, self._new(full), full, self.capacity)
        if self.left[length]:
            self._put(length, int(self.left[length]), self._new(1), 1, self.capacity)

    def look_up(self) -> LookUp:
        return LookUp(np.array(sorted(self.rows), np.int64).reshape(-1, 6))


class LookUp:
    """Sequence and offset for pieces given by length and rank."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.lengths = np.unique(rows[:, 0])
        self.starts = np.searchsorted(rows[:, 0], self.lengths)
        self.ends = np.searchsorted(rows[:, 0], self.lengths, "right")

    def __call__(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.zeros(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        known, firsts = np.unique(lengths[order], return_index=True)
        for length, some in zip(known, np.split(order, firsts[1:])):
            of = np.searchsorted(self.lengths, length)
            start, end = self.starts[of], self.ends[of]
            at[some] = start + np.searchsorted(self.rows[start:end, 1], ranks[some], "right") - 1
        _, first, copies, sequence, _, offset = self.rows[at].T
        step = ranks - first
        return sequence + step // copies, offset + step % copies * lengths


def placed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with the sequence each goes to and its offset there; sequences have no gaps.

    Takes rows with length (1 to the capacity), lane and place, and keeps their other columns but
    these two. The rank of a piece among all of its length is its place and the counts of the
    lanes before: no task holds all pieces of a length. Columns named pack_... are for use within.
    An empty table gives an empty result.
    """
    stored = written(pieces, "pieces")
    cells = stored.groupBy("lane", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(
        cells.select(
            F.col("lane").alias("pack_lane"), F.col("length").alias("pack_length"), "n",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("pack_before"),
        ),
        "lanes",
    )
    counts = offsets.groupBy("pack_length").agg(F.sum("n")).collect()  # one row a length, `capacity` at most
    look_up = Plan(dict(map(tuple, counts)), capacity).look_up()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(name).to_numpy().astype(np.int64) for name in ("length", "pack_rank"))
            sequence, offset = look_up(lengths, ranks)
            names = [name for name in batch.schema.names if name != "pack_rank"]
            arrays = [batch.column(name) for name in names] + [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "sequence_id", "offset"])

    same = (F.col("lane") == F.col("pack_lane")) & (F.col("length") == F.col("pack_length"))
    kept = [name for name in stored.columns if name not in ("lane", "place")]
    ranked = stored.join(offsets.drop("n"), same).select(*kept, (F.col("place") + F.col("pack_before")).alias("pack_rank"))
    schema = stored.select(*kept, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema
    return ranked.mapInArrow(place, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id and its ids, from placed pieces that still have theirs: no more than the
    capacity of tokens come together."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(ordered.alias("parts")).select(
        "sequence_id", F.concat_ws("", F.transform("parts", lambda p: F.hex(p.ids))).alias("ids")
    ).withColumn("ids", F.unhex("ids"))
