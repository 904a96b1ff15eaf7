"""String similarity on a 0-100 scale, as Arrow batches over pairs that are already distinct."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from truegrain.functions.predicates import as_col


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence; every row of the table is one machine word of bits."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    free = full
    for ch in b:
        hit = free & where.get(ch, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(a) - free.bit_count()


def indel_percent(a: str, b: str) -> float:
    size = len(a) + len(b)
    return 100.0 if size == 0 else 200.0 * lcs_length(a, b) / size


def indel_matrix(a: list[str], b: list[str]) -> np.ndarray:
    """`indel_percent` of every text of `a` with every one of `b`, a row of the table for all of `b` at a time."""
    if len(a) * len(b) < 64:
        return np.array([[indel_percent(x, y) for y in b] for x in a], dtype="float64").reshape(len(a), len(b))
    others, back = np.unique(np.array(b, dtype=object), return_inverse=True)
    codes: dict[str, int] = {}
    sizes = np.array([len(y) for y in others])
    places = np.zeros((max(int(sizes.max()), 1), len(others)), dtype=np.int64)  # 0: past the end of a text
    for n, y in enumerate(others):
        places[: len(y), n] = [codes.setdefault(ch, len(codes) + 1) for ch in y]
    known: dict[str, np.ndarray] = {}
    for x in a:
        if x in known:
            continue
        if len(x) > 64:
            known[x] = np.array([indel_percent(x, y) for y in others])
            continue
        where = np.zeros(len(codes) + 1, dtype=np.uint64)
        for i, ch in enumerate(x):
            if ch in codes:
                where[codes[ch]] |= np.uint64(1 << i)
        full = np.uint64((1 << len(x)) - 1)
        free = np.full(len(others), full, dtype=np.uint64)
        for row in places:
            hit = free & where[row]
            free = ((free + hit) | (free - hit)) & full
        lcs = len(x) - np.bitwise_count(free).astype(np.int64)
        size = sizes + len(x)
        known[x] = np.where(size == 0, 100.0, 200.0 * lcs / np.maximum(size, 1))
    return np.array([known[x] for x in a])[:, back]


@pandas_udf(DoubleType())
def _indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(
        [None if x is None or y is None else indel_percent(x, y) for x, y in zip(a, b)],
        dtype="float64",
    )


def indel_ratio(a, b) -> Column:
    """200 * LCS / (len a + len b). Feed it distinct pairs, not raw rows."""
    return _indel_ratio(as_col(a), as_col(b))


def sorted_tokens(col) -> Column:
    return F.array_join(F.array_sort(F.split(F.trim(as_col(col)), "\\s+")), " ")


def token_sort_ratio(a, b) -> Column:
    return indel_ratio(sorted_tokens(a), sorted_tokens(b))
