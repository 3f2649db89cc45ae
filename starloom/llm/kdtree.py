"""K-d trees over letter counts, searched for many vectors at once.

A word of Latin letters becomes the counts of its 90 letters. Changing one letter takes one from
a count and adds one to another; leaving a letter out takes one from a count. So a search has two
radii: how much a count may gain in all and how much it may lose. A box is entered if the way to
it is within both.
"""

from __future__ import annotations

import numpy as np

# The letters A-Z in lower case, and the code points from U+00C0 to U+00FF.
LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)])
LEAF = 16


def letters_of(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of code points, which are all below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def count_vectors(letters: np.ndarray) -> np.ndarray:
    """How often each letter is in each row."""
    rows, length = letters.shape
    counts = np.zeros((rows, 256), np.int16 if length < 1 << 15 else np.int32)
    for first in range(0, rows, 4096):
        some = letters[first : first + 4096]
        at = (np.arange(len(some)) * 256)[:, None] + some
        counts[first : first + 4096] = np.bincount(at.ravel(), minlength=256 * len(some)).reshape(-1, 256)
    return np.ascontiguousarray(counts[:, LETTERS])


class Tree:
    """Leaves of `leaf` vectors at most, or of equal ones; `members` lists the vectors of each."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF):
        self.members: list[np.ndarray] = []
        nodes: list[list[int]] = []  # dimension (-1: a leaf), cut, low, high of it, children or number of the leaf
        bounds = [({}, {})]
        waiting = [(np.arange(len(vectors)), 0)]
        nodes.append([-1, 0, 0, 0, 0, 0])
        while waiting:
            rows, node = waiting.pop()
            low, high = bounds[node]
            bounds[node] = None
            split = self._split(vectors[rows]) if len(rows) > leaf else None
            if split is None:
                nodes[node] = [-1, 0, 0, 0, len(self.members), 0]
                self.members.append(rows)
                continue
            dim, cut = split
            left = vectors[rows, dim] <= cut
            nodes[node] = [dim, cut, low.get(dim, 0), high.get(dim, 1 << 30), len(nodes), len(nodes) + 1]
            for some, box in ((rows[left], (low, high | {dim: cut})), (rows[~left], (low | {dim: cut + 1}, high))):
                waiting.append((some, len(nodes)))
                nodes.append([-1, 0, 0, 0, 0, 0])
                bounds.append(box)
        self.dim, self.cut, self.low, self.high, self.left, self.right = np.array(nodes, np.int64).T

    @staticmethod
    def _split(vectors: np.ndarray) -> tuple[int, int] | None:
        """The letter whose mean parts the vectors most evenly, or nothing if all are equal."""
        cuts = vectors.sum(axis=0, dtype=np.int64) // len(vectors)
        below = (vectors <= cuts.astype(vectors.dtype)).sum(axis=0)
        dim = int(np.argmin(np.abs(2 * below - len(vectors))))
        return None if below[dim] == len(vectors) else (dim, int(cuts[dim]))

    def search(self, vectors: np.ndarray, gain: int, lose: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a vector's row and a leaf that it may reach within the radii."""
        row, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        gained, lost = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), np.int64)
        found = []
        while len(row):
            ends = self.dim[node] < 0
            if ends.any():
                found.append((row[ends], self.left[node[ends]]))
                row, node, gained, lost = (x[~ends] for x in (row, node, gained, lost))
            value, cut = vectors[row, self.dim[node]].astype(np.int64), self.cut[node]
            down = lost + np.maximum(value - cut, 0) - np.maximum(value - self.high[node], 0)
            up = gained + np.maximum(cut + 1 - value, 0) - np.maximum(self.low[node] - value, 0)
            lower, upper = down <= lose, up <= gain
            row = np.concatenate((row[lower], row[upper]))
            node, gained, lost = (
                np.concatenate((self.left[node[lower]], self.right[node[upper]])),
                np.concatenate((gained[lower], up[upper])),
                np.concatenate((down[lower], lost[upper])),
            )
        rows, leaves = zip(*found) if found else ([np.zeros(0, np.int64)],) * 2
        return np.concatenate(rows), np.concatenate(leaves)

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf in whose box each vector lies."""
        row, leaf = self.search(vectors, 0, 0)
        out = np.zeros(len(vectors), np.int64)
        out[row] = leaf
        return out
