"""Forecast models, rolling backtests with retraining policies, measurement error and intervals."""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.functions.predicates import as_col
from truegrain.functions.scalars import calendar_features
from truegrain.operators.diff import union_all
from truegrain.operators.drift import PageHinkley
from truegrain.operators.ranks import join_back, quantiles
from truegrain.session import materialize


def add_calendar(df: DataFrame, date: str, period: float = 365.25) -> DataFrame:
    return df.withColumns(calendar_features(date, period))


@dataclass(frozen=True)
class ForecastSpec:
    date: str
    target: str
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    learner: str = "boosting"  # or "linear"
    rounds: int = 20
    max_bins: int = 256


@dataclass
class ForecastModel:
    model: object
    calibration: float
    prepare: object | None = None  # None where the rows already carry feature vectors

    def predict(self, df: DataFrame, name: str = "pred") -> DataFrame:
        rows = df if self.prepare is None else self.prepare(df)
        scored = self.model.transform(rows)
        return scored.select(*df.columns, (F.expm1(F.col("prediction")) * F.lit(self.calibration)).alias(name))


def _as_text(df: DataFrame, categorical) -> DataFrame:
    for c in categorical:
        df = df.withColumn(c, F.col(c).cast("string"))
    return df


def feature_maker(df: DataFrame, spec: ForecastSpec):
    """Function that adds the feature vector; category codes are learned from `df`."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    index = [f"{c}_index" for c in spec.categorical]
    stages = [StringIndexer(inputCols=list(spec.categorical), outputCols=index, handleInvalid="keep")]
    inputs = index
    if spec.learner == "linear":
        inputs = [f"{c}_hot" for c in spec.categorical]
        stages.append(OneHotEncoder(inputCols=index, outputCols=inputs))
    stages.append(VectorAssembler(inputCols=[*inputs, *spec.numeric], outputCol="features"))
    fitted = Pipeline(stages=stages).fit(_as_text(df, spec.categorical))
    return lambda rows: fitted.transform(_as_text(rows, spec.categorical)).select(*rows.columns, "features")


def _fit(rows: DataFrame, spec: ForecastSpec) -> tuple[object, float]:
    """Model of log1p of the target clipped at 0, and the factor that makes the predicted total of
    the training rows equal to the actual one. `rows` carry feature vectors."""
    from pyspark.ml.regression import GBTRegressor, LinearRegression

    data = rows.withColumn("_label", F.log1p(F.greatest(F.col(spec.target), F.lit(0.0))))
    if spec.learner == "linear":
        learner = LinearRegression(labelCol="_label", featuresCol="features", regParam=1e-4, solver="normal")
    else:
        learner = GBTRegressor(
            labelCol="_label", featuresCol="features", maxIter=spec.rounds, maxDepth=5, maxBins=spec.max_bins, seed=0
        )
    model = learner.fit(data)
    sums = model.transform(data).agg(
        F.sum(F.greatest(F.col(spec.target), F.lit(0.0))).alias("actual"), F.sum(F.expm1("prediction")).alias("predicted")
    ).first()
    return model, sums["actual"] / sums["predicted"] if sums["predicted"] else 1.0


def train(df: DataFrame, spec: ForecastSpec) -> ForecastModel:
    prepare = feature_maker(df, spec)
    model, factor = _fit(prepare(df), spec)
    return ForecastModel(model, factor, prepare)


def _months(start: dt.date, end: dt.date) -> list[tuple[dt.date, dt.date]]:
    out, first = [], start
    while first <= end:
        following = (first.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
        out.append((first, min(following - dt.timedelta(days=1), end)))
        first = following
    return out


def backtest(
    df: DataFrame, spec: ForecastSpec, start: dt.date, end: dt.date, when: str = "never", window_days: int | None = None,
    min_gap_days: int = 14, detector: PageHinkley | None = None, parallelism: int = 4,
) -> tuple[DataFrame, list[dt.date]]:
    """(predictions of every day in the period, retraining days).

    Feature vectors are made once. Whole periods are scored at once: a month, or the part of it until
    an alarm. The alarm policy looks at one total per day, which is all that reaches the driver.
    `when`: never, monthly, alarm.
    """
    day = F.col(spec.date).cast("date")
    detector = detector or PageHinkley(min_instances=7, delta=0.02, threshold=0.5)
    rows = materialize(feature_maker(df, spec)(df), "features")
    last, retrains, parts = start, [], []

    def fit(at: dt.date, days: int | None) -> ForecastModel:
        history = rows.filter(day < F.lit(at))
        if days:
            history = history.filter(day >= F.lit(at - dt.timedelta(days=days)))
        return ForecastModel(*_fit(history, spec))

    periods = [(start, end)] if when == "never" else _months(start, end)
    due = [first for first, _ in periods if when == "monthly" and first.day == 1 and first > start]
    with ThreadPool(parallelism) as pool:  # scheduled fits do not depend on each other
        scheduled = dict(zip(due, pool.map(lambda first: fit(first, window_days), due)))
    model = fit(start, None)
    for first, stop in periods:
        if first in scheduled:
            model, last = scheduled[first], first
            retrains.append(first)
        at = first
        while at <= stop:
            chunk = model.predict(rows.filter(day.between(F.lit(at), F.lit(stop))))
            following = stop + dt.timedelta(days=1)
            if when == "alarm":
                daily = chunk.groupBy(day.alias("d")).agg(F.sum(spec.target).alias("a"), F.sum("pred").alias("p"))
                for row in sorted(daily.collect(), key=lambda r: r["d"]):
                    fired = detector.update(row["a"] / row["p"] if row["p"] else 1.0)
                    tomorrow = row["d"] + dt.timedelta(days=1)
                    if fired and (tomorrow - last).days >= min_gap_days and tomorrow <= end:
                        model, last, following = fit(tomorrow, window_days), tomorrow, tomorrow
                        retrains.append(tomorrow)
                        break
            parts.append(chunk.filter(day < F.lit(following)))
            at = following
    return union_all(*parts).drop("features"), retrains


def strategy_summary(predictions: DataFrame, strategy: str, date: str, actual: str, predicted: str, first_months: int = 8):
    """Mean monthly WAPE of the first months of the year and of the others, per strategy."""
    month = F.month(date)
    monthly = predictions.groupBy(strategy, F.trunc(F.col(date).cast("date"), "month").alias("month"), month.alias("_m")).agg(
        (F.sum(F.abs(as_col(predicted) - as_col(actual))) / F.nullif(F.sum(actual), F.lit(0.0))).alias("wape")
    )
    return monthly.groupBy(strategy).agg(
        F.avg(F.when(F.col("_m") <= first_months, F.col("wape"))).alias("wape_first"),
        F.avg(F.when(F.col("_m") > first_months, F.col("wape"))).alias("wape_last"),
    )


# ---- measurement error ----------------------------------------------------------------------


def _uniform(seed: int, *key: str) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.col(k) for k in key]), 11)
    return (bits.cast("double") + 0.5) / F.lit(float(2**53))


def standard_normal(*key: str, seed: int = 0) -> Column:
    """Normal noise that depends on the key only (Box-Muller on two hash uniforms)."""
    radius = F.sqrt(-2.0 * F.log(_uniform(seed, *key)))
    return radius * F.cos(F.lit(2 * math.pi) * _uniform(seed + 1, *key))


def add_measurement_error(df: DataFrame, column: str, noise: float, bias: float, *key: str, seed: int = 0) -> DataFrame:
    """Four versions of a measured column: clean, imprecise, inaccurate, both."""
    x, eps = F.col(column), standard_normal(*key, seed=seed)
    wobble = lambda v: F.greatest(v * (1 + F.lit(noise) * eps), F.lit(0.0))
    return (
        df.withColumn("clean", x)
        .withColumn("imprecise", wobble(x))
        .withColumn("inaccurate", x * F.lit(1 - bias))
        .withColumn("both", wobble(x * F.lit(1 - bias)))
    )


def grouped_least_squares(df: DataFrame, groups: list[str], features: list[str], target: str) -> DataFrame:
    """Ordinary least squares for many groups at once: the sums of products are one aggregate, and
    only they (features squared per group) are solved, in Arrow batches."""
    terms = [F.lit(1.0), *[F.col(f).cast("double") for f in features]]
    p = len(terms)
    aggs = [F.sum(terms[i] * terms[j]) for i in range(p) for j in range(i, p)]
    sums = df.groupBy(*groups).agg(
        F.array(*aggs).alias("xx"), F.array(*[F.sum(t * F.col(target)) for t in terms]).alias("xy")
    )

    @F.pandas_udf("array<double>")
    def solve(xx: pd.Series, xy: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(xx, xy):
            m = np.zeros((p, p))
            m[np.triu_indices(p)] = a
            m = m + m.T - np.diag(np.diag(m))
            out.append(list(np.linalg.lstsq(m, np.asarray(b, dtype=float), rcond=None)[0]))
        return pd.Series(out)

    return sums.select(*groups, solve("xx", "xy").alias("beta"))


def linear_value(beta: str, features: list[str]) -> Column:
    value = F.col(beta)[0]
    for i, f in enumerate(features):
        value = value + F.col(beta)[i + 1] * F.col(f)
    return value


def learning_curve(
    past: DataFrame, new: DataFrame, unit: str, sizes: list[int], features: list[str], conditions: list[str], truth: str,
    repeats: int = 3,
) -> DataFrame:
    """(condition, size, repeat, mae, mean_error) of linear models trained on growing subsets of days
    and scored against the true values of new rows. All models are fitted in one aggregate."""
    from truegrain.operators.sampling import nested_subsets

    subsets = nested_subsets(past, unit, sizes, repeats)
    long = subsets.select(
        "size", "repeat", *features,
        F.explode(F.array(*[F.struct(F.lit(c).alias("condition"), F.col(c).alias("y")) for c in conditions])).alias("c"),
    ).select("size", "repeat", *features, "c.condition", "c.y")
    models = grouped_least_squares(long, ["condition", "size", "repeat"], features, "y")
    # a few dozen coefficient vectors travel inside one array, and each new row meets all of them
    betas = models.agg(F.collect_list(F.struct("condition", "size", "repeat", "beta"))).scalar()
    scored = new.withColumn("_m", betas).select(truth, *features, F.explode("_m").alias("m")).select(
        truth, *features, "m.condition", "m.size", "m.repeat", "m.beta"
    ).withColumn("pred", linear_value("beta", features))
    return scored.groupBy("condition", "size", "repeat").agg(
        F.avg(F.abs(F.col("pred") - F.col(truth))).alias("mae"), F.avg(F.col("pred") - F.col(truth)).alias("mean_error")
    )


def boosting_curve(
    past: DataFrame, new: DataFrame, spec: ForecastSpec, unit: str, sizes: list[int], conditions: list[str], truth: str,
    repeats: int = 1,
) -> DataFrame:
    """The same curve for boosted trees: one distributed fit per condition, size and repeat."""
    from dataclasses import replace

    from truegrain.operators.sampling import nested_subsets

    subsets = nested_subsets(past, unit, sizes, repeats)
    parts = []
    for condition in conditions:
        for size in sizes:
            for repeat in range(repeats):
                rows = subsets.filter((F.col("size") == size) & (F.col("repeat") == repeat))
                model = train(rows, replace(spec, target=condition))
                parts.append(
                    model.predict(new).agg(
                        F.avg(F.abs(F.col("pred") - F.col(truth))).alias("mae"), F.avg(F.col("pred") - F.col(truth)).alias("mean_error")
                    ).select(F.lit(condition).alias("condition"), F.lit(size).alias("size"), F.lit(repeat).alias("repeat"), "mae", "mean_error")
                )
    return union_all(*parts)


# ---- prediction intervals -------------------------------------------------------------------


def conformal_intervals(
    calibration: DataFrame, new: DataFrame, groups: list[str], actual: str, predicted: str, low: float = 0.1, high: float = 0.9
) -> DataFrame:
    """Quantiles of held-out residuals per group, added to new predictions (split conformal)."""
    residuals = calibration.withColumn("_r", as_col(actual) - as_col(predicted))
    bands = quantiles(residuals, groups, "_r", {"_low": low, "_mid": 0.5, "_high": high})
    p = as_col(predicted)
    return join_back(new, bands, groups).withColumn("low", p + F.col("_low")).withColumn("mid", p + F.col("_mid")).withColumn(
        "high", p + F.col("_high")
    ).drop("_low", "_mid", "_high")
