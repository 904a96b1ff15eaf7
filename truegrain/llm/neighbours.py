"""Nearest neighbours by a block matrix join with int8 tiles and error bounds (operator 10)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.llm.common import group_starts, whole_groups

#: Rows of a block of candidates and of queries, and of the tiles that are multiplied at once.
CANDIDATES, QUERIES, TILE = 16_384, 1_024, (256, 4_096)


def usable(df: DataFrame, vector: str, key: str) -> DataFrame:
    """Rows with a key and a vector that is not null, empty or zero and has finite components only."""
    limit = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))).filter(F.exists(vector, lambda x: x != 0)).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"))


def _blocks(df: DataFrame, rows: int, kind: str) -> DataFrame:
    """(dim, part, n, ids, vectors) blocks of at most `rows` rows, as little-endian numbers; one number of components each."""

    def gather(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, open_, made = TaskContext.get().partitionId(), {}, 0

        def block(dim):
            ids, vectors = open_.pop(dim)
            ids, vectors = np.concatenate(ids), np.concatenate(vectors)
            for s in range(0, len(ids), rows):
                values = [dim, part, None, ids[s : s + rows].astype("<i8").tobytes(), vectors[s : s + rows].astype(kind).tobytes()]
                yield values

        def batch_of(values):
            nonlocal made
            values[2], made = made, made + 1
            types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=["dim", "part", "n", "ids", "vectors"])

        for batch in batches:
            ids, lists = batch.column("id").to_numpy(), batch.column("vector")
            lengths = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(lengths)])
            for dim in np.unique(lengths).tolist():
                of = np.flatnonzero(lengths == dim)
                values = flat[starts[of][:, None] + np.arange(dim)]
                held = open_.setdefault(dim, ([], []))
                held[0].append(ids[of])
                held[1].append(values)
                if sum(map(len, held[0])) >= rows:
                    yield from map(batch_of, block(dim))
        for dim in list(open_):
            yield from map(batch_of, block(dim))

    return df.mapInArrow(gather, "dim int, part int, n int, ids binary, vectors binary")


def quantised(x):
    """int8 values (as float32), scale, squared length of scale x values, and the length of what rounding lost."""
    import numpy as np

    scale = np.abs(x).max(axis=1) / 127
    whole = np.rint(x / scale[:, None])
    return whole.astype(np.float32), scale, (whole**2).sum(axis=1) * scale**2, np.sqrt(((x - whole * scale[:, None]) ** 2).sum(axis=1))


def tile_search(q_ids, q, c_ids, c, k: int, best: list | None = None) -> list[list[tuple[float, int]]]:
    """The k nearest (distance, id) of each query among the candidates, nearest first.

    |x - y| lies within the summed rounding losses of the distance of the int8 forms, whose products
    float32 holds exactly for fewer than 1,040 components (float64 beyond). A candidate survives if its lower bound
    is no more than the k-th upper bound; survivors are measured in float64 and kept in a heap. A
    candidate with the query's own id is left out, and an id counts once, by its nearest vector.
    """
    import heapq

    import numpy as np

    q, c = q.astype(np.float64), c.astype(np.float64)
    best = best or [[] for _ in q_ids]
    exact = np.float32 if q.shape[1] < 1040 else np.float64
    (qi, qs, qn, qe), (ci, cs, cn, ce) = quantised(q), quantised(c)
    slack_q, slack_c = 1e-7 * np.sqrt(qn), 1e-7 * np.sqrt(cn)  # float64 error of a small difference of large numbers
    first = np.zeros(len(c_ids), dtype=bool)
    first[np.unique(c_ids, return_index=True)[1]] = True
    for a in range(0, len(q_ids), TILE[0]):
        for b in range(0, len(c_ids), TILE[1]):
            rows, cols = slice(a, a + TILE[0]), slice(b, b + TILE[1])
            product = qi[rows].astype(exact) @ ci[cols].astype(exact).T
            square = qn[rows, None] + cn[None, cols] - 2 * (qs[rows, None] * cs[None, cols]) * product
            near, lost = np.sqrt(np.maximum(square, 0)), (qe + slack_q)[rows, None] + (ce + slack_c)[None, cols]
            own = q_ids[rows, None] == c_ids[None, cols]
            upper = np.where(own | ~first[None, cols], np.inf, near + lost)
            reach = np.partition(upper, k - 1, axis=1)[:, k - 1] if upper.shape[1] >= k else np.full(len(upper), np.inf)
            reach = np.minimum(reach, [heap[-1][0] if len(heap) == k else np.inf for heap in best[rows]])
            hit_row, hit_col = np.nonzero((near - lost <= reach[:, None]) & ~own)
            bounds = np.searchsorted(hit_row, np.arange(len(upper) + 1))
            for i in range(len(upper)):
                hits = hit_col[bounds[i] : bounds[i + 1]]
                if len(hits):
                    away = np.sqrt(((c[cols][hits] - q[a + i]) ** 2).cumsum(axis=1)[:, -1])  # summed in order
                    best[a + i] = nearest(heapq.merge(best[a + i], sorted(zip(away.tolist(), c_ids[cols][hits].tolist(), strict=True))), k)
    return best


def nearest(merged, k: int) -> list[tuple[float, int]]:
    """The first k of sorted (distance, id) with different ids."""
    out, seen = [], set()
    for distance, i in merged:
        if i not in seen:
            out.append((distance, i))
            seen.add(i)
            if len(out) == k:
                break
    return out


def nearest_neighbours(queries: DataFrame, candidates: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, key, score): each query's k nearest by Euclidean distance, ties to the smaller key.

    Rows without key, and vectors that are null, empty, zero or not finite, take no part; vectors of
    different length are not compared. Blocks of queries (of fixed size) are dealt to every block of
    candidates and multiplied there, so no side is broadcast and no task holds more than its blocks; each tile gives k
    rows a query. A query id with several vectors has the nearest of any of them. The result is exact.
    """
    spark = candidates.sparkSession
    kind = "<f4" if candidates.schema[vector].dataType.elementType.typeName() == "float" and queries.schema[vector].dataType.elementType.typeName() == "float" else "<f8"
    rows, asked = usable(candidates, vector, key), usable(queries, vector, key)
    n_rows, n_asked = rows.count(), asked.count()
    tiles = max(1, math.ceil(n_rows / CANDIDATES), min(spark.sparkContext.defaultParallelism, math.ceil(n_rows / 1000)))
    held = _blocks(rows.repartition(tiles), CANDIDATES, kind)
    sent = _blocks(asked.repartition(max(1, math.ceil(n_asked / QUERIES))), QUERIES, kind)
    sent = sent.select("dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("part"))
    pairs = held.join(sent.hint("shuffle_hash"), ["part", "dim"]).select("part", "n", "dim", "ids", "vectors", "q_ids", "q_vectors")

    def search(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                shape = (-1, row["dim"])
                q_ids, c_ids = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["ids"], "<i8")
                found = tile_search(q_ids, np.frombuffer(row["q_vectors"], kind).reshape(shape), c_ids, np.frombuffer(row["vectors"], kind).reshape(shape), k)
                out = [(int(i), d, j) for i, near in zip(q_ids, found, strict=True) for d, j in near]
                columns = list(zip(*out, strict=True)) if out else [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.int64())], names=["query_id", "score", "id"])

    def merge(batches):
        import pyarrow as pa

        for part in whole_groups(batches, ["query_id"]):
            starts, out = group_starts(part, ["query_id"]), []
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                near = nearest(zip(part["score"][s:e].tolist(), part["id"][s:e].tolist(), strict=True), k)
                out += [(int(part["query_id"][s]), rank, i, d) for rank, (d, i) in enumerate(near, 1)]
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "rank", key, "score"])

    found = pairs.mapInArrow(search, "query_id long, score double, id long")
    return found.repartition("query_id").sortWithinPartitions("query_id", "score", "id").mapInArrow(merge, f"query_id long, rank int, `{key}` long, score double")
