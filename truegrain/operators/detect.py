"""Outlier detectors and learned error detection."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from truegrain.functions.scalars import signed_log1p
from truegrain.operators.ranks import join_back, median_and_mad, medians, running, tail_ranks
from truegrain.session import materialize


def robust_z(df: DataFrame, keys: list[str], value: str, floor: float = 0.05) -> DataFrame:
    """abs(x - median) / (MAD + floor) inside each group."""
    stats = median_and_mad(df, keys, value)
    score = F.abs(F.col(value) - F.col("median")) / (F.col("mad") + F.lit(floor))
    return join_back(df, stats, keys).withColumn("robust_z", score)


def context_features(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Signed log of the value and its deviation from what is typical in the group."""
    logged = df.withColumn("log_value", signed_log1p(value))
    typical = medians(logged, keys, "log_value", "typical")
    return join_back(logged, typical, keys).withColumn("deviation", F.col("log_value") - F.col("typical"))


def ecod(df: DataFrame, cols: list[str]) -> DataFrame:
    """Empirical tail probabilities per dimension; the score is the largest of three sums.

    Tails are computed on distinct values with running counts, and joined back by value.
    """
    skew = df.agg(*[F.skewness(c).alias(c) for c in cols])
    out = df
    left = right = auto = F.lit(0.0)
    for c in cols:
        tails = tail_ranks(df, c).select(
            F.col(c).alias(f"_v_{c}"),
            (-F.log("left_tail")).alias(f"_l_{c}"),
            (-F.log("right_tail")).alias(f"_r_{c}"),
        )
        out = out.join(tails, F.col(c) == F.col(f"_v_{c}"), "left").withColumn(f"_s_{c}", skew.select(c).scalar())
        left = left + F.col(f"_l_{c}")
        right = right + F.col(f"_r_{c}")
        auto = auto + F.when(F.col(f"_s_{c}") < 0, F.col(f"_l_{c}")).otherwise(F.col(f"_r_{c}"))
    return out.select(*df.columns, F.greatest(left, right, auto).alias("ecod"))


# ---- isolation forest -----------------------------------------------------------------------


def _path_constant(n: int) -> float:
    """Mean length of an unsuccessful search in a binary tree of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(points: np.ndarray, depth: int, limit: int, rng, nodes: list) -> int:
    at = len(nodes)
    nodes.append(None)
    spread = points.max(axis=0) - points.min(axis=0) if len(points) else np.zeros(points.shape[1])
    usable = np.flatnonzero(spread > 0)
    if depth >= limit or len(points) <= 1 or len(usable) == 0:
        nodes[at] = (-1, depth + _path_constant(len(points)), -1, -1)
        return at
    axis = int(rng.choice(usable))
    low, high = points[:, axis].min(), points[:, axis].max()
    cut = float(rng.uniform(low, high))
    below = points[:, axis] < cut
    left = _grow(points[below], depth + 1, limit, rng, nodes)
    right = _grow(points[~below], depth + 1, limit, rng, nodes)
    nodes[at] = (axis, cut, left, right)
    return at


def fit_isolation_forest(df: DataFrame, row_id: str, cols: list[str], trees: int = 100, size: int = 256, seed: int = 0):
    """Trees as arrays of nodes. Each tree sees `size` rows chosen by hash: a narrow filter keeps
    about twice as many rows as needed, then each tree takes its own first `size` of them. What
    returns to the driver is trees * 2 * size nodes, whatever the table holds."""
    clean = df.select(row_id, *[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    rows = clean.count()
    share = min(1.0, 2.0 * trees * size / max(rows, 1))
    slot = F.pmod(F.xxhash64(F.lit(seed), F.col(row_id)), F.lit(1_000_000))
    picked = clean.filter(slot < F.lit(math.ceil(share * 1_000_000)))
    copies = max(1, math.ceil(2.0 * trees * size / max(rows * share, 1)))
    spread = picked.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    mixed = F.xxhash64(F.lit(seed + 1), F.col(row_id), F.col("_copy"))
    assigned = spread.withColumn("tree", F.pmod(mixed, F.lit(trees)).cast("int"))
    place = F.row_number().over(Window.partitionBy("tree").orderBy(F.xxhash64(F.lit(seed + 2), F.col(row_id), F.col("_copy")), row_id))
    sample = assigned.withColumn("_place", place).filter(F.col("_place") <= size).select("tree", *cols)
    limit = math.ceil(math.log2(max(size, 2)))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        ordered = pdf[cols].sort_values(cols).to_numpy(dtype=float)
        nodes: list = []
        _grow(ordered, 0, limit, np.random.default_rng([seed, tree]), nodes)
        axis, value, left, right = zip(*nodes)
        return pd.DataFrame(
            {"tree": [tree], "n": [len(ordered)], "axis": [list(axis)], "value": [list(value)], "left": [list(left)], "right": [list(right)]}
        )

    schema = "tree int, n int, axis array<int>, value array<double>, left array<int>, right array<int>"
    grown = sample.groupBy("tree").applyInPandas(grow, schema).orderBy("tree").collect()
    return [
        (g["n"], np.array(g["axis"]), np.array(g["value"]), np.array(g["left"]), np.array(g["right"])) for g in grown
    ]


def isolation_score(forest, cols: list[str]) -> Column:
    """2 ** (-mean path length / expected length): near 1 is isolated."""
    expected = _path_constant(max(n for n, *_ in forest))

    @pandas_udf(T.DoubleType())
    def score(*series: pd.Series) -> pd.Series:
        points = np.column_stack([s.to_numpy(dtype=float) for s in series])
        total = np.zeros(len(points))
        start, flat = np.arange(len(points)) * points.shape[1], points.ravel()
        for _, axis, value, left, right in forest:
            # a leaf leads to itself, so all points go down together
            leaf, here = axis < 0, np.arange(len(axis))
            split, cut = np.where(leaf, 0, axis), np.where(leaf, -np.inf, value)
            children = np.column_stack([np.where(leaf, here, right), np.where(leaf, here, left)]).ravel()
            at = np.zeros(len(points), dtype=int)
            while not leaf[at].all():
                at = children[2 * at + (flat[start + split[at]] < cut[at])]
            total += value[at]
        return pd.Series(np.power(2.0, -(total / len(forest)) / max(expected, 1e-9)))

    return score(*[F.col(c).cast("double") for c in cols])


def isolation_forest(df, row_id, cols, trees: int = 100, size: int = 256, seed: int = 0) -> DataFrame:
    forest = fit_isolation_forest(df, row_id, cols, trees, size, seed)
    return df.withColumn("isolation", isolation_score(forest, cols))


# ---- local outlier factor -------------------------------------------------------------------


def _lof_line(x: np.ndarray, k: int) -> np.ndarray:
    """LOF of sorted points on a line: the k nearest lie within k places on either side."""
    n = len(x)
    k = min(k, n - 1)
    if k < 1:
        return np.full(n, 1.0)
    around = np.lib.stride_tricks.sliding_window_view(np.pad(x, k), 2 * k + 1)
    gaps = np.abs(np.delete(around, k, axis=1) - x[:, None])
    for i in range(k):  # places before the first and behind the last point
        gaps[i, : k - i] = np.inf
        gaps[n - 1 - i, k + i :] = np.inf
    nearest = np.argsort(gaps, axis=1, kind="stable")[:, :k]
    index = np.arange(n)[:, None] + nearest - k + (nearest >= k)
    distance = np.take_along_axis(gaps, nearest, axis=1)
    reach = np.maximum(distance[:, -1][index], distance)
    density = 1.0 / (reach.mean(axis=1) + 1e-10)
    return density[index].mean(axis=1) / density


def lof(df: DataFrame, row_id: str, value: str, keys: list[str] | None = None, k: int = 100, chunk: int = 2000):
    """Exact local outlier factor of one feature inside blocks.

    Rows get their rank by (value, id); a chunk of consecutive ranks plus 3k ranks on both sides
    holds everything the factor of its rows depends on, so no task sees more than chunk + 6k rows.
    Equal values are numerous at times: distances of zero give huge densities, as the definition has it.
    """
    keys = keys or []
    base = df.select(row_id, *keys, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    counts = base.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_n"))
    first = running(counts, keys, "_x", {"_upto": ("sum", "_n")}).withColumn("_start", F.col("_upto") - F.col("_n"))
    # ties: the place among equal values is a running count by id inside (key, value)
    tied = running(base.withColumn("_one", F.lit(1)), [*keys, "_x"], row_id, {"_place": ("sum", "_one")})
    ranked = join_back(tied, first.select(*keys, "_x", "_start"), [*keys, "_x"]).withColumn(
        "_rank", F.col("_start") + F.col("_place") - 1
    )
    halo = 3 * k
    low = F.greatest(F.floor((F.col("_rank") - halo) / chunk), F.lit(0))
    high = F.floor((F.col("_rank") + halo) / chunk)
    pieces = ranked.withColumn("_chunk", F.explode(F.sequence(low, high))).withColumn(
        "_own", F.floor(F.col("_rank") / chunk) == F.col("_chunk")
    )
    schema = T.StructType([df.schema[row_id], T.StructField("lof", T.DoubleType())])

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_rank")
        factor = _lof_line(pdf["_x"].to_numpy(), k)
        own = pdf["_own"].to_numpy(dtype=bool)
        return pd.DataFrame({row_id: pdf[row_id].to_numpy()[own], "lof": factor[own]})

    return pieces.select(row_id, *keys, "_x", "_rank", "_own", "_chunk").groupBy(*keys, "_chunk").applyInPandas(score, schema)


# ---- learning from past repairs -------------------------------------------------------------


def _prepare(categorical: list[str], numeric: list[str]):
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    indexed = [f"{c}_index" for c in categorical]
    stages = []
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=indexed + numeric, outputCol="features"))
    return stages


def _as_text(df: DataFrame, categorical: list[str]) -> DataFrame:
    for c in categorical:
        df = df.withColumn(c, F.col(c).cast("string"))
    return df


def learn_from_repairs(past: DataFrame, label: str, categorical: list[str], numeric: list[str], rounds: int = 20, max_bins: int = 256):
    """Gradient-boosted trees on rows people corrected or not; max_bins must cover the categories."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier

    data = _as_text(past, categorical).withColumn("_label", F.col(label).cast("double"))
    model = GBTClassifier(labelCol="_label", featuresCol="features", maxIter=rounds, maxDepth=4, maxBins=max_bins, seed=0)
    return Pipeline(stages=[*_prepare(categorical, numeric), model]).fit(data)


def score_new_rows(model, df: DataFrame, categorical: list[str]) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    out = model.transform(_as_text(df, categorical))
    return out.withColumn("p", vector_to_array("probability")[1]).select(*df.columns, "p")


def permutation_importance(
    model, df: DataFrame, row_id: str, label: str, categorical: list[str], numeric: list[str], repeats: int = 5
) -> DataFrame:
    """Mean loss of AUC when one column is shuffled across rows.

    A shuffle pairs row i of one pseudo-random order with row i of another one. Both orders are
    running counts over hash values, in buckets of the hash. Each repeat joins once;
    a row then becomes one row per feature with that feature swapped, and all are scored together.
    """
    from truegrain.operators.aggregates import roc_auc
    from truegrain.operators.diff import union_all

    features = [*categorical, *numeric]
    base = _as_text(df.select(row_id, label, *features), categorical)
    base = base.select(row_id, F.col(label).cast("boolean").alias(label), *features)
    whole = roc_auc(score_new_rows(model, base, categorical), [], "p", F.col(label)).first()["auc"]
    numbered = base.join(_row_numbers(base.select(row_id), row_id, 0), row_id)
    others = union_all(
        *[
            _row_numbers(base, row_id, i + 1).select(
                "_number", F.lit(i).alias("repeat"), F.struct(*features).alias("_other")
            )
            for i in range(repeats)
        ]
    )
    swapped = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(f).alias("feature"),
                    *[(F.col(f"_other.{c}") if c == f else F.col(c)).alias(c) for c in features],
                )
                for f in features
            ]
        )
    )
    mixed = numbered.join(others, "_number").select("repeat", label, swapped.alias("x")).select("repeat", label, "x.*")
    scored = materialize(score_new_rows(model, mixed, categorical).select("feature", "repeat", label, "p"), "shuffled")
    return (
        roc_auc(scored, ["feature", "repeat"], "p", F.col(label))
        .groupBy("feature")
        .agg(F.avg(F.lit(whole) - F.col("auc")).alias("importance"))
    )


def _row_numbers(df: DataFrame, row_id: str, seed: int) -> DataFrame:
    """Dense row numbers in a pseudo-random order of the rows, counted in 256 buckets by the first byte of the hash."""
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), F.col(row_id))).withColumn("_bucket", F.shiftright("_hash", 56))
    sizes = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", row_id))
    numbered = hashed.withColumn("_place", place).join(F.broadcast(sizes.select("_bucket", earlier.alias("_before"))), "_bucket")
    return numbered.select(*df.columns, (F.col("_before") + F.col("_place")).alias("_number"))


def compare_detectors(scores: DataFrame, detector: str, score: str, row_id: str, truth: Column) -> DataFrame:
    """Precision in the top k, average precision and AUC per detector, from long scores."""
    from truegrain.operators.aggregates import average_precision, precision_at_k, roc_auc

    top = precision_at_k(scores, [detector], score, row_id, truth)
    ap = average_precision(scores, [detector], score, truth)
    return top.join(ap, detector).join(roc_auc(scores, [detector], score, truth), detector)
