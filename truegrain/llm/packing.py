"""Packing token pieces into windows: combinations by non-negative least squares, then a greedy rest (operator 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from truegrain.llm.common import numbered
from truegrain.llm.tokens import tokenizer_path, word_ids
from truegrain.session import materialize

#: Pieces of up to FINE tokens have a size class each; longer ones are rounded up to multiples of UNIT.
FINE, UNIT, END = 64, 16, 2


def token_pieces(docs: DataFrame, key: str, text: str, path: str, window: int, end: int) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, size): each document's ids and `end`, cut at multiples of the window."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "size"))])

    def cut(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        ids_of, last = word_ids(path), np.array([end], dtype="<u4").tobytes()
        for batch in batches:
            at, rows = [], []
            for i, value in enumerate(batch.column(1)):
                ids = ids_of.ids(value.as_py()) + last
                n = len(ids) // 4
                for start in range(0, n, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    length = len(piece) // 4
                    at.append(i)
                    rows.append((start, length, zlib.crc32(piece), n, length if length <= FINE else -(-length // UNIT) * UNIT))
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [()] * 5)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], names=schema.names)

    return docs.select(F.col(key), F.col(text)).mapInArrow(cut, schema)


def nonnegative_least_squares(a, b, rounds: int = 2000):
    """x >= 0 that minimises |a x - b|, by an active set; the passive columns are solved for exactly."""
    import numpy as np

    scale = float(np.abs(b).max()) or 1.0
    b, x, passive = b / scale, np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    for _ in range(rounds):
        gain = np.where(passive, -np.inf, a.T @ (b - a @ x))
        best = int(gain.argmax())
        if gain[best] <= 1e-9:
            break
        passive[best] = True
        while True:
            on = np.flatnonzero(passive)
            s = a[:, on]
            solved = np.linalg.solve(s.T @ s + 1e-9 * np.eye(len(on)), s.T @ b)
            if solved.min() > 0:
                x[:] = 0
                x[on] = solved
                break
            bad = solved <= 0
            step = (x[on][bad] / (x[on][bad] - solved[bad] + 1e-300)).min()
            x[on] += step * (solved - x[on])
            passive[on[x[on] <= 1e-12]] = False
            x[~passive] = 0
            if not passive.any():
                break
    return x * scale


def combinations_of(window: int, unit: int, least: int):
    """Multisets of one to three multiples of the unit, from `least` on, that fill the window."""
    n, low = window // unit, max(1, -(-least // unit))
    yield (n * unit,)
    for a in range(low, n // 2 + 1):
        yield ((n - a) * unit, a * unit)
    for a in range(low, n // 3 + 1):
        for b in range(a, (n - a) // 2 + 1):
            yield ((n - a - b) * unit, b * unit, a * unit)


def packing_plan(histogram: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """[(pieces of each size, sequences)] that use up a histogram of sizes; its cost depends on the number of sizes only.

    The repeat counts of three-deep combinations come from least squares, rounded and kept within what
    is there. What is left, short pieces above all, fills windows largest first; the same filling is
    repeated as often as its pieces last.
    """
    import numpy as np

    left, plan = {s: n for s, n in histogram.items() if n}, []
    grid = [s for s in range(UNIT, window + 1, UNIT) if s > FINE]
    shapes = [c for c in combinations_of(window, UNIT, FINE + UNIT) if all(s in left for s in c)]
    if shapes:
        rows = {s: i for i, s in enumerate(grid)}
        a = np.zeros((len(grid), len(shapes)))
        for j, shape in enumerate(shapes):
            for s in shape:
                a[rows[s], j] += 1
        counts = np.rint(nonnegative_least_squares(a, np.array([float(left.get(s, 0)) for s in grid])))
        for j in sorted(range(len(shapes)), key=lambda j: -counts[j]):
            uses = {s: shapes[j].count(s) for s in shapes[j]}
            n = min([int(counts[j]), *(left[s] // m for s, m in uses.items())])
            if n:
                plan.append((uses, n))
                for s, m in uses.items():
                    left[s] -= n * m
    left = {s: n for s, n in left.items() if n}
    while left:
        room, uses = window, {}
        for s in sorted(left, reverse=True):
            if m := min(left[s], room // s):
                uses[s] = m
                room -= m * s
        n = min(left[s] // m for s, m in uses.items())
        plan.append((uses, n))
        for s, m in uses.items():
            left[s] -= n * m
            if not left[s]:
                del left[s]
    return plan


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, window: int = 4096, end: int = END) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece of every document.

    Null and empty texts are one piece of the end id. Rows that repeat a key are documents of their
    own. Pieces are narrow rows: they are counted by size class, the plan is made from those counts,
    and each piece finds its sequence from its rank within its class. Texts are read once.
    """
    # written first, so a task runs one Python worker at a time
    rows = numbered(materialize(token_pieces(docs, key, text, path or tokenizer_path(), window, end), "pieces"), "size", "_rank")
    counts = {r[0]: r[1] for r in rows.groupBy("size").count().collect()}  # a row for each size class
    base, taken, ranges = 0, dict.fromkeys(counts, 0), {s: [] for s in counts}
    for uses, n in packing_plan(counts, window):
        slot = 0
        for s, m in uses.items():
            ranges[s].append((taken[s], base, m, slot))
            taken[s] += n * m
            slot += m
        base += n

    schema = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, _slot long".format(docs.schema[key].dataType.simpleString())

    def place(batches):
        import numpy as np
        import pyarrow as pa

        tables = {s: np.array(r, dtype=np.int64) for s, r in ranges.items()}
        for batch in batches:
            sizes, ranks = batch.column("size").to_numpy(), batch.column("_rank").to_numpy()
            sequence, slot = np.zeros_like(ranks), np.zeros_like(ranks)
            for s in np.unique(sizes):
                of = np.flatnonzero(sizes == s)
                t = tables[int(s)]
                row = t[np.searchsorted(t[:, 0], ranks[of], side="right") - 1]
                local = ranks[of] - row[:, 0]
                sequence[of], slot[of] = row[:, 1] + local // row[:, 2], row[:, 3] + local % row[:, 2]
            kept = [batch.column(n) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(slot)], names=[*("doc_id", "start", "length", "ids_crc32", "doc_tokens"), "sequence_id", "_slot"])

    # a sequence holds at most `window` pieces
    before = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.mapInArrow(place, schema).withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return placed.select(F.col("doc_id").alias(key), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
