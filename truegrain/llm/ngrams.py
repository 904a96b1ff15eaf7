"""Hashed character n-grams of whole texts, as numpy arrays inside a task."""

from __future__ import annotations

#: Characters looked at together; longer texts go through in blocks that overlap, so memory is bounded.
BLOCK = 1 << 19


def letter_table():
    """Whether a code point is a letter, for all of Unicode."""
    import numpy as np

    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), dtype=bool, count=0x110000)


def letters_of(text: str, table):
    """Code points of the lower-cased text; each run of other characters is one space, and so are both ends."""
    import numpy as np

    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = table[points]
    behind = np.empty_like(letter)
    behind[:1] = False
    behind[1:] = letter[:-1]
    kept = np.where(letter, points, 32)[letter | behind]
    tail = [] if len(kept) and kept[-1] == 32 else [32]
    return np.concatenate([[32], kept, tail]).astype(np.uint64)


def buckets(points, orders, bits: int):
    """Yields arrays of buckets in [0, 2^bits), one for each n-gram of the given orders."""
    import numpy as np

    mix, step, top = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x100000001B3), max(orders)
    for start in range(0, max(1, len(points)), BLOCK):
        block = points[start : start + BLOCK + top - 1]
        own = min(BLOCK, len(points) - start)
        rolled = block
        for n in range(1, top + 1):
            if n > 1:
                if len(block) < n:
                    break
                rolled = rolled[:-1] * step + block[n - 1 :]
            if n in orders:
                spread = (rolled[:own] ^ (rolled[:own] >> np.uint64(29)) ^ np.uint64(n << 56)) * mix
                spread = (spread ^ (spread >> np.uint64(32))) * mix
                yield (spread >> np.uint64(64 - bits)).astype(np.int64)
