"""Local outlier factors over several features, exact at any size.

Equal vectors are one point with a count. Points are dealt to the cells of a tree whose nodes are cut at
approximate quantiles of one feature after the other; the cuts only decide who does the work. Each point
has a radius that is proved to hold its k nearest rows: the diagonal of the least node with more than k
rows, then the k-th distance within its cell. It visits the cells its ball meets, found by the same cuts.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truegrain.session import materialize

#: Children of a node, points from which it is cut, visits of a cell that one task answers.
WAYS, CELL, VISITS = 16, 2048, 8192
#: Added to the mean reachability distance, so that points in one place have a density.
LEAST = 1e-10


def _child(cuts: Column, value: Column) -> Column:
    return F.size(F.filter(cuts, lambda cut: cut < value))


def _feature(depth: int, count: int) -> str:
    return f"x{depth % count}"


def _levels(points: DataFrame, count: int, k: int, cell: int) -> tuple[DataFrame, list[DataFrame]]:
    """(points with their cell in `node` and a proved radius, the nodes of each level with their cuts).

    A level cuts one feature. Cutting ends when no node holds more than `cell` points, or when a round over all features
    left the largest node as it was: its features hardly vary.
    """
    xs = [f"x{i}" for i in range(count)]
    levels, largest, points = [], [], points.withColumn("radius", F.lit(None).cast("double"))
    while True:
        cut = _feature(len(levels), count)
        shares = F.array(*[F.lit(i / WAYS) for i in range(1, WAYS)])
        sides = [F.pow(F.max(x) - F.min(x), F.lit(2)) for x in xs]
        nodes = points.groupBy("node").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("w").alias("rows"),
            F.sqrt(reduce(lambda a, b: a + b, sides)).alias("diagonal"),
            F.array_distinct(F.percentile_approx(cut, shares, F.lit(1000))).alias("cuts"),
        )
        levels.append(materialize(nodes, "nodes"))
        largest.append(levels[-1].agg(F.max("n")).first()[0] or 0)
        # a diagonal is rounded: a little more holds the node for certain
        wide = F.col("diagonal") * (1 + 1e-9)
        joined = points.join(levels[-1], "node").withColumn("radius", F.when(F.col("rows") > k, wide).otherwise(F.coalesce("radius", wide)))
        done = largest[-1] <= cell or (len(largest) > count and largest[-1] == largest[-1 - count])
        if not done:
            child = F.concat("node", F.lit("/"), _child(F.col("cuts"), F.col(cut)))
            joined = joined.withColumn("node", F.when(F.col("n") > cell, child).otherwise(F.col("node")))
        points = materialize(joined.select("node", "id", "w", *xs, "radius"), "points")
        if done:
            return points, levels


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of a and b, the same for (p, q) and (q, p)."""
    total = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        total += (a[:, i, None] - b[None, :, i]) ** 2
    return np.sqrt(total)


def _kth(gaps: np.ndarray, own: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """Per row of gaps, the distance within which lie k rows beside the point's own; inf if there are fewer. `own` marks the point's place."""
    order = np.argsort(gaps, axis=1, kind="stable")
    held = weights[order] - np.take_along_axis(own, order, axis=1)
    enough = np.cumsum(held, axis=1) >= k
    at = enough.argmax(axis=1)
    found = np.take_along_axis(np.take_along_axis(gaps, order, axis=1), at[:, None], axis=1)[:, 0]
    return np.where(enough.any(axis=1), found, np.inf)


def neighbours(points: DataFrame, count: int, k: int, cell: int = CELL) -> DataFrame:
    """(p, q, w, d): of each point (node, id, w, x0, x1, ...) the rows no farther than its k-th nearest, ties included.

    `node` names the block a point belongs to; neighbours are of the same block. w counts the rows of q,
    less the point's own one.
    """
    xs = [f"x{i}" for i in range(count)]
    points, levels = _levels(points, count, k, cell)

    def narrow(pdf: pd.DataFrame) -> pd.DataFrame:
        vectors, weights = pdf[xs].to_numpy(), pdf.w.to_numpy()
        found = np.empty(len(pdf))
        for s in range(0, len(pdf), 256):
            rows = np.arange(s, min(s + 256, len(pdf)))
            found[rows] = _kth(_distances(vectors[rows], vectors), rows[:, None] == np.arange(len(pdf)), weights, k)
        return pdf.assign(radius=np.minimum(pdf.radius.to_numpy(), found))

    points = materialize(points.groupBy("node").applyInPandas(narrow, points.schema), "radii")
    visits = points.select(F.split("node", "/")[0].alias("node"), F.col("id").alias("p"), *xs, "radius")
    for depth, nodes in enumerate(levels[:-1]):
        x = F.col(_feature(depth, count))
        reach = F.col("radius") * (1 + 1e-9) + F.abs(x) * 1e-12
        met = F.sequence(_child(F.col("cuts"), x - reach), _child(F.col("cuts"), x + reach))
        met = F.transform(met, lambda c: F.concat(F.col("node"), F.lit("/"), c.cast("string")))
        stays = F.array(F.col("node"))
        visits = visits.join(nodes.select("node", "n", "cuts"), "node").withColumn("node", F.explode(F.when(F.col("n") > cell, met).otherwise(stays))).drop("n", "cuts")
    visits = materialize(visits, "visits")
    parts = visits.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / VISITS).cast("int").alias("parts"))
    asked = visits.join(parts, "node").withColumn("part", F.pmod(F.xxhash64("p"), F.col("parts")).cast("int")).drop("parts")
    held = points.join(parts, "node").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "radius")

    def answer(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        vectors, weights, names = members[xs].to_numpy(), members.w.to_numpy(), members.id.to_numpy()
        out = []
        for s in range(0, len(queries) if len(members) else 0, 256):
            some = queries.iloc[s : s + 256]
            gaps, own = _distances(some[xs].to_numpy(), vectors), some.p.to_numpy()[:, None] == names[None, :]
            limit = np.minimum(some.radius.to_numpy(), _kth(gaps, own, weights, k))
            x, y = np.nonzero((gaps <= limit[:, None]) & (weights - own > 0))
            out.append(pd.DataFrame({"p": some.p.to_numpy()[x], "q": names[y], "w": (weights - own)[x, y], "d": gaps[x, y]}))
        return pd.concat(out) if out else pd.DataFrame({"p": [], "q": [], "w": [], "d": []})

    hits = asked.groupBy("node", "part").cogroup(held.groupBy("node", "part")).applyInPandas(answer, "p long, q long, w long, d double")
    nearer = Window.partitionBy("p").orderBy("d")
    upto = hits.withColumn("upto", F.sum("w").over(nearer))
    # of the hits those count that have fewer than k rows strictly nearer
    same = Window.partitionBy("p", "d")
    return upto.withColumn("tied", F.sum("w").over(same)).filter(F.col("upto") - F.col("tied") < k).select("p", "q", "w", "d")


def lof(df: DataFrame, row_id: str, values: list[str], keys: list[str] | None = None, k: int = 100, cell: int = CELL) -> DataFrame:
    """(row_id, lof): exact local outlier factors over several features, by Euclidean distance, inside blocks.

    The neighbourhood of a row holds the k nearest other rows and all that are as far as the k-th, so
    ties don't depend on an order. In a block of k rows or fewer all others are neighbours; a row
    alone has the factor 1. Rows with a NULL, NaN or infinite feature have none and are left out; NULL is a key like
    others. More than k equal rows have the density 1 / LEAST. Features are taken as they are: scale them first.
    """
    xs, keys = [f"x{i}" for i in range(len(values))], keys or []
    known = reduce(lambda a, b: a & b, [F.col(x).isNotNull() & (F.abs(x) < float("inf")) for x in xs])
    block = F.translate(F.to_json(F.struct(*[F.col(c) for c in keys])), "/", "\u0001") if keys else F.lit("")
    base = df.select(F.col(row_id).alias("row_id"), block.alias("node"), *[(F.col(v).cast("double") + 0.0).alias(x) for v, x in zip(values, xs, strict=True)]).filter(known)
    distinct = base.groupBy("node", *xs).agg(F.count(F.lit(1)).alias("w"))
    points = materialize(distinct.withColumn("id", F.monotonically_increasing_id()), "vectors")
    near = materialize(neighbours(points.select("node", "id", "w", *xs), len(xs), k, cell), "neighbours")
    kth = near.groupBy("p").agg(F.max("d").alias("kth"))
    reached = near.join(kth.select(F.col("p").alias("q"), "kth"), "q")
    density = reached.groupBy("p").agg((1 / (F.sum(F.col("w") * F.greatest("kth", "d")) / F.sum("w") + LEAST)).alias("density"))
    density = materialize(density, "densities")
    around = near.join(density.select(F.col("p").alias("q"), "density"), "q").groupBy("p").agg((F.sum(F.col("w") * F.col("density")) / F.sum("w")).alias("around"))
    factors = around.join(density, "p").select(F.col("p").alias("id"), (F.col("around") / F.col("density")).alias("lof"))
    scored = points.join(factors, "id", "left").select("node", *xs, F.coalesce("lof", F.lit(1.0)).alias("lof"))
    return base.join(scored, ["node", *xs]).select(F.col("row_id").alias(row_id), "lof")
