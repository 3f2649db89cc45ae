"""Words, shingles and their hashes for a block of texts at once.

A word is a run of bytes other than 0x20 and 0x09 to 0x0D. Hashes are polynomials over 64 bits
of randomly drawn values, so that any slice's hash is a difference of two running sums. Where
equal hashes are taken for equal texts, two independent ones are used: 128 bits.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ONE = np.uint64(1)


def seeded(name: str, count: int) -> np.ndarray:
    """`count` 64-bit values drawn from a name, the same in every process."""
    drawn = hashlib.shake_256(name.encode()).digest(8 * count)
    return np.frombuffer(drawn, np.uint64).copy()


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


class Rolling:
    """Hashes of slices of a sequence, modulo 2^64."""

    def __init__(self, name: str):
        self.base = int(seeded(name, 1)[0] | ONE)
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, count: int) -> None:
        if len(self.powers) >= count:
            return
        size = 1 << (count - 1).bit_length()
        for field, step in (("powers", self.base), ("inverses", self.inverse)):
            values = np.ones(size, np.uint64)
            done = 1
            while done < size:
                values[done : 2 * done] = values[:done] * np.uint64(pow(step, done, 1 << 64))
                done *= 2
            setattr(self, field, values)

    def sums(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=out[1:])
        return out

    def slices(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))


_BYTES = [(Rolling(f"bytes {k}"), seeded(f"byte values {k}", 256)) for k in range(2)]
_WORDS = [Rolling(f"words {k}") for k in range(2)]


@dataclass
class Words:
    """Words of a block: where each starts and ends in its bytes, and which text it is of."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    counts: np.ndarray  # words of each text
    firsts: np.ndarray  # index of each text's first word

    def hashes(self, which: int = 0) -> np.ndarray:
        rolling, values = _BYTES[which]
        return rolling.slices(rolling.sums(values[self.data]), self.starts, self.ends)

    def windows(self, width: int) -> np.ndarray:
        """Indices of the words at which a window of `width` words of one text starts."""
        if len(self.text) < width:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.text[width - 1 :] == self.text[: len(self.text) - width + 1])


def find_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    if lower:
        data = LOWER[data]
    count = len(offsets) - 1
    inside = ~IS_SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    bounds = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[bounds] = inside[bounds]
    lasts = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    closes[lasts] = inside[lasts]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    text = np.searchsorted(offsets, starts, "right") - 1
    counts = np.bincount(text, minlength=count)
    firsts = np.zeros(count, np.int64)
    np.cumsum(counts[:-1], out=firsts[1:])
    return Words(data, starts, ends, text, counts, firsts)


def window_hashes(hashes: np.ndarray, starts: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Hashes of the windows of `width` words that start at the given words."""
    rolling = _WORDS[which]
    return rolling.slices(rolling.sums(hashes), starts, starts + width)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` consecutive values."""
    reach, out = 1, values
    while 2 * reach <= width:
        out = np.minimum(out[: len(out) - reach], out[reach:])
        reach *= 2
    if reach < width:
        shift = width - reach
        out = np.minimum(out[: len(out) - shift], out[shift:])
    return out
