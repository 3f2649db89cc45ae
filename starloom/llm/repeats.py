"""Removal of word passages that occur more than once, with a count-min prefilter.

Every window of `WINDOW` words has an anchor: of its runs of `GRAM` words, the one with the
smallest hash. Equal windows have equal anchors at equal places, so an anchor is counted at least
as often as any window that it stands for: the sketch of anchors overestimates window counts,
and only windows whose anchor may be repeated go on to the exact grouping. About a tenth as many
anchors as windows are counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import sketch
from starloom.llm.common import few_rows, pack_texts, text_blocks, unpack_texts, written
from starloom.llm.words import Rolling, Words, find_words, mix, sliding_minimum, window_hashes

WINDOW = 35
GRAM = 16
#: The sketch may take 2 * 2^27 bits, 32 MB.
MOST_BITS = 27
#: An anchor with more rows is split by window hash, so that no task holds more of one.
MOST_ROWS = 4096
_CONTEXTS = Rolling("contexts")
_PLACE = np.uint64((1 << 34) - 1)


def anchors(hashes: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `gram` words, and for each window of `width` words its anchor's place.

    Places rise with the window; of runs with the same hash the first is taken.
    """
    if len(hashes) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = window_hashes(hashes, np.arange(len(hashes) - gram + 1), gram)
    ordered = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    return grams, (sliding_minimum(ordered, width - gram + 1) & _PLACE).astype(np.int64)


def row_key() -> F.Column:
    return F.xxhash64("doc_id", "text")


def _kept_words(words: Words, text: int, removed: np.ndarray) -> bytes:
    keep = np.flatnonzero(~removed) + words.firsts[text]
    return b" ".join(words.data[s:e].tobytes() for s, e in zip(words.starts[keep].tolist(), words.ends[keep].tolist()))


def packed_texts(documents: DataFrame) -> DataFrame:
    """row_key, doc_id and the text as zstd, which shuffles in a third of its bytes."""

    def pack(batches):
        for batch in few_rows(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pack_texts(batch.column(2))], ["row_key", "doc_id", "packed"])

    return documents.select(row_key().alias("row_key"), "doc_id", "text").mapInArrow(pack, "row_key long, doc_id long, packed binary")


def parted(rows: DataFrame, most_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose anchors have at most `most_rows` of them, and all others.

    Counts combine before the shuffle. An n-th of the rows at most are heavy anchors, if n is
    `most_rows`; they are few enough to be sent to every task.
    """
    heavy = written(rows.groupBy("anchor").count().where(F.col("count") > most_rows).select("anchor"), "heavy")
    return tuple(rows.join(F.broadcast(heavy), "anchor", how) for how in ("left_anti", "left_semi"))


def split_verdicts(rows: DataFrame) -> DataFrame:
    """anchor, context and mask of stretches, with no group held: windows are counted by
    (anchor, window), combined before the shuffle, and those that repeat are joined back."""

    def explode(batches):
        names = ["anchor", "window", "context", "bit", "n"]
        for batch in few_rows(batches):
            lists = batch.column("windows").to_pylist()
            sizes = np.array([len(x) // 8 for x in lists], np.int64)
            if not len(sizes):
                continue
            first = np.cumsum(sizes) - sizes
            bits = np.int64(1) << (np.arange(sizes.sum()) - np.repeat(first, sizes))
            anchor, context, n = (np.repeat(np.asarray(batch.column(c)), sizes) for c in ("anchor", "context", "n"))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor, np.frombuffer(b"".join(lists), np.int64), context, bits, n)], names)

    windows = rows.select("anchor", "context", "windows", "n").mapInArrow(explode, "anchor long, window long, context long, bit long, n long")
    again = windows.groupBy("anchor", "window").agg(F.sum("n").alias("n")).where("n > 1").select("anchor", "window")
    return windows.drop("n").join(again, ["anchor", "window"]).groupBy("anchor", "context").agg(F.bit_or("bit").alias("mask"))


def repeated_windows(
    documents: DataFrame, window: int = WINDOW, gram: int = GRAM, most_bits: int = MOST_BITS, most_rows: int = MOST_ROWS
) -> DataFrame:
    """(row_key, start, mask): bit k says that the window at word start + k occurs elsewhere too.

    Consecutive windows with the same anchor travel as one row of window hashes. Equal rows of a
    task are sent once with their places, so that a passage found in very many texts weighs on
    no single task; counts are summed per distinct row, and the verdicts joined back. A passage
    between different texts gives its anchor a row in every text: anchors of more than
    `most_rows` rows are split by window.
    """
    reach = window - gram + 1
    if not 1 <= reach <= 60:
        raise ValueError("window - gram must be from 0 to 59")
    spark = documents.sparkSession
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def anchor_keys(texts: pa.Array) -> Iterator[np.ndarray]:
        for _, _, data, offsets in text_blocks(texts):
            words = find_words(data, offsets)
            grams, places = anchors(words.hashes(), window, gram)
            places = places[words.windows(window)]
            yield grams[places[np.concatenate(([True], places[1:] != places[:-1]))]] if len(places) else grams[:0]

    counted = sketch.build(documents.select("text"), anchor_keys, size // 50, most_bits)
    bits, repeated = counted.bits, spark.sparkContext.broadcast(counted.repeated)

    def candidates(batches):
        names = ["anchor", "context", "windows", "n", "places"]
        found = sketch.Sketch(bits, repeated.value)
        for batch in batches:
            keys = np.asarray(batch.column(0))
            for first, _, data, offsets in text_blocks(batch.column(1)):
                words = find_words(data, offsets)
                hashes = words.hashes()
                grams, places = anchors(hashes, window, gram)
                starts = words.windows(window)
                if not len(starts):
                    continue
                places = places[starts]
                opens = np.flatnonzero(np.concatenate(([True], (places[1:] != places[:-1]) | (starts[1:] != starts[:-1] + 1))))
                counts = np.diff(np.append(opens, len(starts)))
                flagged = found.maybe_repeated(grams[places[opens]])
                opens, counts = opens[flagged], counts[flagged]
                if not len(opens):
                    continue
                index = np.repeat(opens - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
                windows = window_hashes(words.hashes(1), starts[index], window, 1)
                bounds = np.concatenate(([0], np.cumsum(counts)))
                anchor = grams[places[opens]]
                context = _row_hashes(windows, bounds, places[opens] - starts[opens])
                at = starts[opens]
                text = words.text[at]
                order = np.lexsort((context, anchor))
                heads = np.concatenate(([True], (anchor[order][1:] != anchor[order][:-1]) | (context[order][1:] != context[order][:-1])))
                group = np.flatnonzero(heads)
                n = np.diff(np.append(group, len(order)))
                where = np.empty(len(order), np.dtype([("key", "<i8"), ("start", "<i4")]))
                where["key"], where["start"] = keys[first + text[order]], at[order] - words.firsts[text[order]]
                blob, cuts = where.tobytes(), 12 * np.append(group, len(order))
                lead = order[group]
                lists = [windows[bounds[k] : bounds[k + 1]].tobytes() for k in lead.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[lead].view(np.int64)),
                        pa.array(context[lead].view(np.int64)),
                        pa.array(lists, pa.binary()),
                        pa.array(n.astype(np.int64)),
                        pa.array([blob[s:e] for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.binary()),
                    ],
                    names,
                )

    rows = written(
        documents.select(row_key(), "text").mapInArrow(candidates, "anchor long, context long, windows binary, n long, places binary"),
        "candidates",
    )
    light, heavy = parted(rows, most_rows)
    distinct = light.groupBy("anchor", "context", "windows").agg(F.sum("n").alias("n"))

    def count(batches):
        """Reads rows sorted by anchor; windows are equal only if their anchors are."""
        held: list[pa.RecordBatch] = []

        def judged(table: pa.Table) -> pa.RecordBatch:
            lists = table.column("windows").to_pylist()
            sizes = np.array([len(x) // 8 for x in lists], np.int64)
            windows = np.frombuffer(b"".join(lists), np.uint64)
            anchor = np.repeat(np.asarray(table.column("anchor")), sizes)
            n = np.repeat(np.asarray(table.column("n")), sizes)
            order = np.lexsort((windows, anchor))
            heads = np.concatenate(([True], (windows[order][1:] != windows[order][:-1]) | (anchor[order][1:] != anchor[order][:-1])))
            group = np.cumsum(heads) - 1
            total = np.bincount(group, weights=n[order])[group] > 1
            again = np.empty(len(order), bool)
            again[order] = total
            bounds = np.concatenate(([0], np.cumsum(sizes)))
            bit = again.astype(np.int64) << (np.arange(len(order)) - np.repeat(bounds[:-1], sizes))
            masks = np.add.reduceat(bit, bounds[:-1])
            keep = masks != 0
            return pa.RecordBatch.from_arrays(
                [table.column(name).combine_chunks().filter(pa.array(keep)) for name in ("anchor", "context")] + [pa.array(masks[keep])],
                ["anchor", "context", "mask"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            anchor = np.asarray(batch.column("anchor"))
            changes = np.flatnonzero(anchor != anchor[-1])
            if len(changes):  # the last anchor may go on in the next batch
                cut = int(changes[-1]) + 1
                held[-1] = batch.slice(0, cut)
                yield judged(pa.Table.from_batches(held))
                held = [batch.slice(cut)]
        if held:
            yield judged(pa.Table.from_batches(held))

    verdicts = (
        distinct.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(count, "anchor long, context long, mask long")
    ).unionByName(split_verdicts(heavy))

    def placed(batches):
        for batch in batches:
            blobs = batch.column(0).to_pylist()
            where = np.frombuffer(b"".join(blobs), np.dtype([("key", "<i8"), ("start", "<i4")]))
            masks = np.repeat(np.asarray(batch.column(1)), [len(x) // 12 for x in blobs])
            yield pa.RecordBatch.from_arrays(
                [pa.array(where["key"].copy()), pa.array(where["start"].copy()), pa.array(masks)], ["row_key", "start", "mask"]
            )

    return (
        rows.select("anchor", "context", "places")
        .join(verdicts, ["anchor", "context"])
        .select("places", "mask")
        .mapInArrow(placed, "row_key long, start int, mask long")
    )


def _row_hashes(windows: np.ndarray, bounds: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """A hash for each run of window hashes and the anchor's offset in the first of them."""
    sums = _CONTEXTS.sums(windows)
    return mix(_CONTEXTS.slices(sums, bounds[:-1], bounds[1:]) + offset.astype(np.uint64))


def without_repeats(
    documents: DataFrame, window: int = WINDOW, gram: int = GRAM, most_bits: int = MOST_BITS, most_rows: int = MOST_ROWS
) -> DataFrame:
    """Removes every word that a window covers which starts anywhere else too.

    Returns a row per row of `documents`: doc_id, n_words, n_removed, kept_text (kept words
    joined by one space) and kept_sha256. A null or empty text has no words; its kept text is
    empty. A text shorter than the window loses nothing. Rows that occur twice repeat each other
    and lose all words in windows. A null doc_id is kept as it is; other columns are ignored; an
    empty table gives an empty result.
    """
    marks = (
        repeated_windows(documents, window, gram, most_bits, most_rows)
        .groupBy("row_key")
        .agg(F.collect_list(F.struct("start", "mask")).alias("marks"))
    )

    def cut(batches):
        names = ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"]
        for batch in few_rows(batches):
            texts = unpack_texts(batch.column(1))
            lists = batch.column(2)
            for first, last, data, offsets in text_blocks(texts):
                words = find_words(data, offsets)
                removed_counts, kept, digests = [], [], []
                for k in range(last - first):
                    removed = np.zeros(words.counts[k], bool)
                    of = lists[first + k]
                    if of.is_valid and len(of.values):
                        start, mask = (np.asarray(of.values.field(c)) for c in ("start", "mask"))
                        windows = np.zeros(words.counts[k] + 1, np.int32)
                        for bit in range(window - gram + 1):
                            on = start[(mask >> bit) & 1 > 0] + bit
                            windows[on] = 1
                        at = np.flatnonzero(windows)
                        cover = np.zeros(words.counts[k] + 1, np.int32)
                        np.add.at(cover, at, 1)
                        np.add.at(cover, at + window, -1)
                        removed = np.cumsum(cover)[:-1] > 0
                    out = _kept_words(words, k, removed)
                    removed_counts.append(int(removed.sum()))
                    kept.append(out)
                    digests.append(hashlib.sha256(out).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(removed_counts, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                        pa.array(digests, pa.string()),
                    ],
                    names,
                )

    return (
        packed_texts(documents)
        .join(marks, "row_key", "left")
        .select("doc_id", "packed", "marks")
        .mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string")
    )
