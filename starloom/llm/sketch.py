"""A count-min sketch of anchor hashes, built in partitions and merged slice by slice.

Cells count to two, which is all that "is it repeated?" asks: each partition sends the cells it
has seen and those it has seen twice; their merge is exact. What comes back is one bit a cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.words import mix, seeded

DEPTH = 2
SLICE_BITS = 16
MERGED_SLICES = 32
_SEEDS = seeded("sketch rows", DEPTH)


def cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    return mix(keys ^ _SEEDS[row]) >> np.uint64(64 - bits)


class Sketch:
    """Bits of the cells that were counted twice, `DEPTH` rows of 2^bits cells."""

    def __init__(self, bits: int, repeated: np.ndarray):
        self.bits, self.repeated = bits, repeated

    def maybe_repeated(self, keys: np.ndarray) -> np.ndarray:
        """False only for keys that were added once at most."""
        out = np.ones(len(keys), bool)
        for row in range(DEPTH):
            at = cells(keys, row, self.bits)
            out &= (self.repeated[row][(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out


def bits_for(expected: int, most_bits: int) -> int:
    """Eight cells an expected key, up to the size that may be broadcast."""
    return int(min(max(int(8 * max(expected, 1)).bit_length(), SLICE_BITS + 1), most_bits))


def _sent(keys: np.ndarray, bits: int) -> pa.RecordBatch:
    slices, seen, again = [], [], []
    for row in range(DEPTH):
        found, counts = np.unique(cells(keys, row, bits), return_counts=True)
        of = (found >> np.uint64(SLICE_BITS)).astype(np.int64)
        local = (found & np.uint64((1 << SLICE_BITS) - 1)).astype(np.uint16)
        firsts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else []
        for first, last in zip(firsts, [*firsts[1:], len(of)]):
            slices.append((row << (bits - SLICE_BITS)) + int(of[first]))
            seen.append(local[first:last].tobytes())
            again.append(local[first:last][counts[first:last] > 1].tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(slices, pa.int64()), pa.array(seen, pa.binary()), pa.array(again, pa.binary())], ["slice", "seen", "again"]
    )


def build(texts: DataFrame, keys: Callable[[pa.Array], Iterator[np.ndarray]], expected: int, most_bits: int) -> Sketch:
    """A sketch of all `keys` of the texts, a frame of the one column `text`.

    It takes 2 * 2^bits bits. With more keys than fit `most_bits` it still finds all repeated
    keys, but also takes more single ones for repeated.
    """
    bits = bits_for(expected, most_bits)
    limit = 1 << 20

    def count(batches):
        pending, size = [], 0
        for batch in batches:
            for some in keys(batch.column(0)):
                pending.append(some)
                size += len(some)
                if size >= limit:
                    yield _sent(np.concatenate(pending), bits)
                    pending, size = [], 0
        if size:
            yield _sent(np.concatenate(pending), bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            for of, seen, again in zip(*(batch.column(k).to_pylist() for k in ("slice", "seen", "again"))):
                if of not in once:
                    once[of], twice[of] = np.zeros(1 << SLICE_BITS, bool), np.zeros(1 << SLICE_BITS, bool)
                at = np.frombuffer(seen, np.uint16)
                twice[of][at] |= once[of][at]
                once[of][at] = True
                twice[of][np.frombuffer(again, np.uint16)] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(twice), pa.int64()), pa.array([np.packbits(x, bitorder="little").tobytes() for x in twice.values()], pa.binary())],
            ["slice", "bits"],
        )

    parts = texts.mapInArrow(count, "slice long, seen binary, again binary")
    merged = parts.groupBy(F.floor(F.col("slice") / MERGED_SLICES).alias("part")).applyInArrow(merge, "slice long, bits binary")
    repeated = np.zeros((DEPTH, 1 << (bits - 3)), np.uint8)
    flat, width = repeated.reshape(-1), 1 << (SLICE_BITS - 3)
    for of, some in merged.collect():  # 2 * 2^bits bits in all, whatever the input
        flat[of * width : (of + 1) * width] = np.frombuffer(bytes(some), np.uint8)
    return Sketch(bits, repeated)
