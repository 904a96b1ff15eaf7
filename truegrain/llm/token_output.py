"""Packed token matrices by best-fit-decreasing with a segment tree over capacities (operator 9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.llm.tokens import byte_pairs, tokenizer_path

#: Tokens packed together, which bounds a task's memory; about a thousand windows of 4096.
BLOCK_TOKENS = 1 << 22
#: The vocabulary, and the id behind its last that ends a document and fills a window.
VOCABULARY, END = "byte_bpe_50k.tiktoken", 50256


class CapacityTree:
    """How many open windows there are of each remaining capacity; finds the tightest that fits in log time."""

    def __init__(self, most: int):
        self.leaves = 1
        while self.leaves <= most:
            self.leaves *= 2
        self.counts = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int = 1) -> None:
        at = capacity + self.leaves
        while at:
            self.counts[at] += n
            at //= 2

    def tightest(self, size: int) -> int | None:
        """The least capacity of at least `size` that some window has: up to the first right neighbour with windows, then down its left side."""
        at = size + self.leaves
        if self.counts[at]:
            return size
        while at > 1 and (at % 2 or not self.counts[at + 1]):
            at //= 2
        if at <= 1:
            return None
        at += 1
        while at < self.leaves:
            at = 2 * at if self.counts[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit_decreasing(sizes: list[int], window: int) -> list[list[int]]:
    """Windows as lists of item numbers, the longest item first; each goes where the least room is left over."""
    tree, open_, windows = CapacityTree(window), {}, []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        room = tree.tightest(sizes[item])
        if room is None:
            at, room = len(windows), window
            windows.append([])
        else:
            at = open_[room].pop()
            tree.add(room, -1)
        windows[at].append(item)
        left = room - sizes[item]
        if left:
            open_.setdefault(left, []).append(at)
            tree.add(left)
    return windows


def packed_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, window: int = 4096, end: int = END, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row a packed window: (shard, row, doc_ids, starts, cu_seqlens, resets, ids, used).

    `ids` are the window's ids, little-endian unsigned 32 bit, padded with `end`; piece i has ids
    cu_seqlens[i] to cu_seqlens[i + 1], belongs to doc_ids[i] and begins at token starts[i] of it.
    `resets` are the places where positions begin at 0 again, the padding's among them. A document is its ids and one `end`;
    those over a window are cut at multiples of it and nothing is lost. Null and empty texts are the
    `end` alone. A task packs its own documents in blocks of some `block_tokens`, so nothing is shuffled.
    """
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("row", T.IntegerType()), T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())), T.StructField("resets", T.ArrayType(T.IntegerType())), T.StructField("ids", T.BinaryType()), T.StructField("used", T.IntegerType())])
    path = path or tokenizer_path(VOCABULARY)

    def pack(batches):
        from array import array

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encode, last, shard, row = byte_pairs(path).encode_ordinary, np.array([end], dtype="<u4").tobytes(), TaskContext.get().partitionId(), 0
        pieces: list[tuple] = []
        held, of_batch = 0, None

        def emit():
            nonlocal row, pieces, held
            for windows in _portions(best_fit_decreasing([len(p[2]) // 4 for p in pieces], window)):
                out = [[] for _ in range(8)]
                for w in windows:
                    lengths = [len(pieces[i][2]) // 4 for i in w]
                    ends = np.cumsum([0, *lengths]).tolist()
                    resets = ends if ends[-1] < window else ends[:-1]
                    values = (shard, row, [pieces[i][0] for i in w], [pieces[i][1] for i in w], ends, resets, b"".join(pieces[i][2] for i in w) + last * (window - ends[-1]), ends[-1])
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                    row += 1
                types = [pa.int32(), pa.int32(), pa.list_(of_batch), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=schema.names)
            pieces, held = [], 0

        for batch in batches:
            of_batch = batch.column(0).type
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = array("I", encode(value.as_py() or "")).tobytes() + last
                for start in range(0, len(ids) // 4, window):
                    pieces.append((name, start, ids[4 * start : 4 * (start + window)]))
                    held += len(pieces[-1][2]) // 4
                    if held >= block_tokens:
                        yield from emit()
        if pieces:
            yield from emit()

    return docs.select(F.col(key), F.col(text)).mapInArrow(pack, schema)


def _portions(windows, n: int = 256):
    for i in range(0, len(windows), n):
        yield windows[i : i + n]


def write_packed(packed: DataFrame, folder: str) -> DataFrame:
    """Write the packed rows as Parquet, a file for each shard, and read them back; Spark commits the write as a whole."""
    packed.write.parquet(folder)
    return packed.sparkSession.read.schema(packed.schema).parquet(folder)
