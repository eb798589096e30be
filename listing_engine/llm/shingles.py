"""Hashes of words and of word windows, vectorised over one text.

Words are runs of bytes that are not ASCII white space.  A word's hash is a
polynomial over its bytes modulo 2^64, a window's one over its word hashes;
both come from one prefix sum, since an odd base has an inverse: the sum
between two places, divided by the base's power at the first, doesn't depend
on where the word or window stands.  A final mixing spreads the bits.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

CHUNK = 1 << 16  # bytes hashed at a time
KEPT_POWERS = 1 << 17  # of each base; longer runs are worked out when they come
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95  # odd
_POWERS: dict = {}


def mixed(x):
    """The finaliser of SplitMix64."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int):
    """base^0 ... base^(n-1) and their inverses modulo 2^64."""
    import numpy as np

    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 14, 1 << (n - 1).bit_length())
        steps = [np.full(size, b, dtype=np.uint64) for b in (base, pow(base, -1, 1 << 64))]
        for s in steps:
            s[0] = 1
        have = tuple(np.cumprod(s) for s in steps)
        if size <= KEPT_POWERS:
            _POWERS[base] = have
    return have[0][:n], have[1][:n]


def prefix(values, base: int):
    """(sums, inverses): the hash of values[i:j] is (sums[j] - sums[i]) * inverses[i]."""
    import numpy as np

    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums, down


def byte_tables():
    import numpy as np

    space = np.zeros(256, dtype=bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    return space, mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BYTE_BASE))


def word_hashes(raw: bytes, tables):
    """One 64-bit hash per word of the UTF-8 bytes, in order."""
    import re

    import numpy as np

    space, value = tables
    out, start, gap = [], 0, re.compile(rb"[\x20\x09-\x0d]")
    while start < len(raw):
        end = len(raw)
        if end - start > CHUNK:  # cut at white space, however far it is
            cut = gap.search(raw, start + CHUNK)
            end = cut.start() if cut else end
        a = np.frombuffer(raw, dtype=np.uint8, count=end - start, offset=start)
        blank = space[a]
        edge = np.diff(np.concatenate(([True], blank, [True])).astype(np.int8))
        first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums, down = prefix(value[a], BYTE_BASE)
        out.append(mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)))
        start = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def window_hashes(words, size: int):
    """One 64-bit hash per window of `size` consecutive words."""
    import numpy as np

    if len(words) < size:
        return np.zeros(0, dtype=np.uint64)
    sums, down = prefix(words, WORD_BASE)
    return mixed((sums[size:] - sums[:-size]) * down[:len(words) - size + 1])


cloudpickle.register_pickle_by_value(sys.modules[__name__])
