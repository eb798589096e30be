"""Minimal perfect hashing of a bounded set of 64-bit keys, vectorised.

Keys are hashed into a bit array somewhat larger than their number; those that
meet no other key there are placed, the rest go on to a smaller array with
another hash, until none is left.  A key's place is the rank of its bit over
all arrays, so n keys have the places 0 ... n - 1.  A key that isn't in the
set would get a place too, so the keys are kept in order of place and compared.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

from .shingles import mixed

GAMMA = 1.5  # cells per key of a level
STEP = 0x9E3779B97F4A7C15


class MinimalPerfectHash:
    """Places of a set of distinct unsigned 64-bit keys."""

    def __init__(self, keys):
        import numpy as np

        left = np.unique(np.asarray(keys, dtype=np.uint64))
        self.size, self.levels, placed = len(left), [], 0
        while len(left):
            cells = max(64, int(GAMMA * len(left)))
            at = self._cell(left, len(self.levels), cells)
            alone = np.bincount(at, minlength=cells) == 1
            rank = np.where(alone, placed + np.cumsum(alone) - 1, -1)
            self.levels.append(rank)
            placed += int(alone.sum())
            left = left[~alone[at]]
        self.keys = np.zeros(self.size, dtype=np.uint64)
        if self.size:
            every = np.asarray(keys, dtype=np.uint64)
            self.keys[self._place(every)] = every

    @staticmethod
    def _cell(keys, level: int, cells: int):
        import numpy as np

        salt = np.uint64((level + 1) * STEP & (1 << 64) - 1)
        return (mixed(keys ^ salt) % np.uint64(cells)).astype(np.int64)

    def _place(self, keys):
        import numpy as np

        place, open_ = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, rank in enumerate(self.levels):
            place[open_] = rank[self._cell(keys[open_], level, len(rank))]
            open_ = open_[place[open_] < 0]
            if not len(open_):
                break
        return place

    def place(self, keys):
        """The place of each key, -1 for a key that isn't in the set."""
        import numpy as np

        keys = np.asarray(keys, dtype=np.uint64)
        place = self._place(keys)
        if self.size:
            place[(place < 0) | (self.keys[place] != keys)] = -1
        return place


cloudpickle.register_pickle_by_value(sys.modules[__name__])
