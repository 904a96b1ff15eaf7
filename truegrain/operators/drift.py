"""Drift of data, concepts and schemas: distribution distances, sequential detectors, monitoring."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.operators.aggregates import regression_metrics
from truegrain.operators.diff import union_all
from truegrain.operators.ranks import heavy, join_back, ks_statistic, running, value_counts
from truegrain.operators.validate import threshold_alerts


def psi(df: DataFrame, keys: list[str], category: str, is_reference: Column, eps: float = 1e-4) -> DataFrame:
    """Population stability index of a category between reference and current rows, per key.

    Categories are those of either side; shares get eps added and are not normalised again.
    """
    counts = df.groupBy(*keys, category).agg(
        F.sum(F.when(is_reference, 1).otherwise(0)).alias("_r"),
        F.sum(F.when(is_reference, 0).otherwise(1)).alias("_c"),
    )
    totals = counts.groupBy(*keys).agg(F.sum("_r").alias("_rt"), F.sum("_c").alias("_ct"))
    p = F.col("_r") / F.nullif(F.col("_rt"), F.lit(0)) + F.lit(eps)
    q = F.col("_c") / F.nullif(F.col("_ct"), F.lit(0)) + F.lit(eps)
    return join_back(counts, totals, keys).groupBy(*keys).agg(F.sum((q - p) * F.log(q / p)).alias("psi"))


def welch(df: DataFrame, keys: list[str], value: str, is_reference: Column) -> DataFrame:
    """Mean shift (current minus reference), Welch's t and its degrees of freedom, per key."""

    def part(condition, name):
        x = F.when(condition, F.col(value))
        return [F.avg(x).alias(f"_m{name}"), F.var_samp(x).alias(f"_v{name}"), F.count(x).alias(f"_n{name}")]

    stats = df.groupBy(*keys).agg(*part(is_reference, "r"), *part(~is_reference, "c"))
    a = F.col("_vr") / F.nullif(F.col("_nr"), F.lit(0))
    b = F.col("_vc") / F.nullif(F.col("_nc"), F.lit(0))
    t = (F.col("_mr") - F.col("_mc")) / F.nullif(F.sqrt(a + b), F.lit(0.0))
    df_ = (a + b) * (a + b) / F.nullif(a * a / (F.col("_nr") - 1) + b * b / (F.col("_nc") - 1), F.lit(0.0))
    enough = (F.col("_nr") > 1) & (F.col("_nc") > 1)
    return stats.select(
        *keys,
        (F.col("_mc") - F.col("_mr")).alias("mean_shift"),
        F.when(enough, t).alias("t"),
        F.when(enough, df_).alias("df"),
    )


def student_t_p(t: float, df: float) -> float:
    """Two-sided p-value by the continued fraction of the incomplete beta function."""
    if t is None or df is None or math.isnan(t):
        return float("nan")
    x, a, b = df / (df + t * t), df / 2.0, 0.5
    if x >= 1.0:
        return 1.0
    swap = x > (a + 1) / (a + b + 2)
    if swap:
        x, a, b = 1 - x, b, a
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    c, d = 1.0, 1.0 / max(1 - (a + b) * x / (a + 1), 1e-300)
    total = d
    for m in range(1, 300):
        for number in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / (1 + number * d if abs(1 + number * d) > 1e-300 else 1e-300)
            c = 1 + number / c if abs(1 + number / c) > 1e-300 else 1e-300
            total *= c * d
        if abs(c * d - 1) < 1e-13:
            break
    value = front * total
    return 1 - value if swap else value


def with_p_value(tests: DataFrame) -> DataFrame:
    """Add p to Welch results, one row per key, in Arrow batches."""

    @F.pandas_udf(T.DoubleType())
    def p(t: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series([student_t_p(x, y) for x, y in zip(t, df)], dtype="float64")

    return tests.withColumn("p", p("t", "df"))


def wasserstein(df: DataFrame, keys: list[str], value: str, is_reference: Column, spread: bool | None = None):
    """Wasserstein-1 distance over the reference deviation: area between the two distributions."""
    if spread is None:
        spread = heavy(df, keys)
    counts = value_counts(
        df, keys, value, n_ref=F.when(is_reference, 1).otherwise(0), n_cur=F.when(is_reference, 0).otherwise(1)
    )
    ranked = running(
        counts, keys, value, {"ref": ("sum", "n_ref"), "cur": ("sum", "n_cur")}, totals=True, spread=spread
    )
    ranked = _next_value(ranked, keys, value, spread)
    height = F.abs(F.col("ref") / F.nullif(F.col("total_ref"), F.lit(0)) - F.col("cur") / F.nullif(F.col("total_cur"), F.lit(0)))
    area = ranked.groupBy(*keys).agg(F.sum(height * (F.col("_next") - F.col(value))).alias("_area"))
    scale = df.filter(is_reference).groupBy(*keys).agg(F.stddev_pop(value).alias("_sd"))
    return join_back(area, scale, keys).select(
        *keys, (F.col("_area") / F.nullif(F.col("_sd"), F.lit(0.0))).alias("distance")
    )


def _next_value(df: DataFrame, keys: list[str], value: str, spread: bool) -> DataFrame:
    """The following distinct value inside a key: the lowest one over a descending exclusive run."""
    if not spread:
        return df.withColumn("_next", F.lead(value).over(Window.partitionBy(*keys).orderBy(value)))
    down = df.withColumn("_down", -F.col(value))
    return running(down, keys, "_down", {"_next": ("min", value)}, inclusive=False, spread=True).drop("_down")


def jensen_shannon(df: DataFrame, keys: list[str], category: str, is_reference: Column) -> DataFrame:
    """Jensen-Shannon distance (base 2, square root) of a category, per key; NULL if a side is empty."""
    counts = df.groupBy(*keys, category).agg(
        F.sum(F.when(is_reference, 1).otherwise(0)).alias("_r"),
        F.sum(F.when(is_reference, 0).otherwise(1)).alias("_c"),
    )
    totals = counts.groupBy(*keys).agg(F.sum("_r").alias("_rt"), F.sum("_c").alias("_ct"))
    p = F.col("_r") / F.nullif(F.col("_rt"), F.lit(0))
    q = F.col("_c") / F.nullif(F.col("_ct"), F.lit(0))
    m = (p + q) / 2
    term = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    divergence = F.sum((term(p) + term(q)) / 2)
    both = (F.max("_rt") > 0) & (F.max("_ct") > 0)
    return join_back(counts, totals, keys).groupBy(*keys).agg(
        F.when(both, F.sqrt(F.greatest(divergence, F.lit(0.0)))).alias("distance")
    )


def column_drift(
    df: DataFrame, keys: list[str], numeric: list[str], categorical: list[str], is_reference: Column,
    limit: float = 0.1, methods: dict[str, str] | None = None,
) -> DataFrame:
    """(keys, column_name, method, distance, drifted) per column. Methods: wasserstein, ks, js, psi.

    Where one side has no rows the distance is NULL and the column is not called drifted.
    """
    methods = methods or {}
    parts = []
    for c in [*numeric, *categorical]:
        method = methods.get(c, "wasserstein" if c in numeric else "js")
        if method == "wasserstein":
            out = wasserstein(df, keys, c, is_reference)
        elif method == "ks":
            out = ks_statistic(df, keys, c, is_reference).withColumnRenamed("ks", "distance")
        elif method == "psi":
            out = psi(df, keys, c, is_reference).withColumnRenamed("psi", "distance")
        else:
            out = jensen_shannon(df, keys, c, is_reference)
        parts.append(out.select(*keys, F.lit(c).alias("column_name"), F.lit(method).alias("method"), "distance"))
    return union_all(*parts).withColumn("drifted", F.coalesce(F.col("distance") > limit, F.lit(False)))


def drifted_share(columns: DataFrame, keys: list[str]) -> DataFrame:
    return columns.groupBy(*keys).agg(F.avg(F.col("drifted").cast("int")).alias("drifted_share"))


def out_of_range(value: str, lo: float, hi: float) -> Column:
    return F.count_if(~F.col(value).between(lo, hi))


def weekly_drift(rows: DataFrame, number: str, category: str, quantity: str) -> DataFrame:
    """KS, mean shift, Welch test, PSI and KS of log1p per week, from rows labelled by
    seasonal_windows (columns week and is_reference)."""
    ref = F.col("is_reference")
    logged = rows.withColumn("_log", F.log1p(quantity))
    return (
        ks_statistic(rows, ["week"], number, ref)
        .join(welch(rows, ["week"], number, ref), "week")
        .join(psi(rows, ["week"], category, ref), "week")
        .join(ks_statistic(logged, ["week"], "_log", ref).withColumnRenamed("ks", "ks_log"), "week")
    )


# ---- sequential detectors -------------------------------------------------------------------


class PageHinkley:
    """Two-sided Page-Hinkley test with forgetting; all state restarts after an alarm."""

    def __init__(self, min_instances=30, delta=0.005, threshold=50.0, alpha=0.9999, state=None):
        self.min_instances, self.delta, self.threshold, self.alpha = min_instances, delta, threshold, alpha
        self.state = list(state) if state else [0, 0.0, 0.0, 0.0, math.inf, -math.inf]

    def update(self, x: float) -> bool:
        n, mean, up, down, up_min, down_max = self.state
        n += 1
        mean += (x - mean) / n
        up = self.alpha * up + (x - mean - self.delta)
        down = self.alpha * down + (x - mean + self.delta)
        up_min, down_max = min(up_min, up), max(down_max, down)
        alarm = n >= self.min_instances and (up - up_min > self.threshold or down_max - down > self.threshold)
        self.state = [0, 0.0, 0.0, 0.0, math.inf, -math.inf] if alarm else [n, mean, up, down, up_min, down_max]
        return alarm


def page_hinkley(
    series: DataFrame, keys: list[str], date: str, value: str,
    min_instances: int = 14, delta: float = 1.0, threshold: float = 40.0, alpha: float = 0.9999,
) -> DataFrame:
    """All alarms (keys, date) of daily series. A key holds one row per day, so a group is a calendar."""
    schema = T.StructType([series.schema[c] for c in [*keys, date]])

    def detect(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date)
        test = PageHinkley(min_instances, delta, threshold, alpha)
        return pdf.loc[[test.update(x) for x in pdf[value]], [*keys, date]]

    return series.select(*keys, date, value).groupBy(*keys).applyInPandas(detect, schema)


def first_page_hinkley(
    series: DataFrame, keys: list[str], date: str, value: str,
    min_instances: int = 14, delta: float = 1.0, threshold: float = 40.0,
) -> DataFrame:
    """First alarm per key without forgetting (alpha 1), in closed form with running windows."""
    order = Window.partitionBy(*keys).orderBy(date)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    steps = series.withColumn("_n", F.row_number().over(order)).withColumn("_mean", F.avg(value).over(upto))
    gap = F.col(value) - F.col("_mean")
    sums = steps.withColumn("_up", F.sum(gap - F.lit(delta)).over(upto)).withColumn(
        "_down", F.sum(gap + F.lit(delta)).over(upto)
    )
    high = F.col("_up") - F.min("_up").over(upto) > threshold
    low = F.max("_down").over(upto) - F.col("_down") > threshold
    alarms = sums.withColumn("_alarm", (F.col("_n") >= min_instances) & (high | low))
    return alarms.filter("_alarm").groupBy(*keys).agg(F.min(date).alias("first_alarm"))


def scaled_ratio_stream(
    daily: DataFrame, keys: list[str], date: str, ratio: str, is_reference: Column, floor: float = 0.02
) -> DataFrame:
    """(ratio - 1) / max(sd, floor) of the live days; sd of the reference, else of the live days."""
    ref = daily.filter(is_reference).groupBy(*keys).agg(F.stddev_samp(ratio).alias("_ref_sd"))
    live = daily.filter(~is_reference)
    own = live.groupBy(*keys).agg(F.stddev_samp(ratio).alias("_own_sd"))
    joined = join_back(join_back(live, own, keys), ref, keys, "left")
    sd = F.greatest(F.coalesce("_ref_sd", "_own_sd"), F.lit(floor))
    return joined.withColumn("x", (F.col(ratio) - 1) / sd).drop("_ref_sd", "_own_sd")


def delay_summary(events: DataFrame, alarms: DataFrame, within_days: int = 60) -> DataFrame:
    """Event x detector x delay. events: event, detector, stream, start; alarms: detector, stream, day."""
    a = alarms.select("detector", "stream", F.col("day").alias("_day")).distinct()
    in_time = (F.col("_day") >= F.col("start")) & (F.col("_day") <= F.date_add("start", within_days))
    return (
        events.join(a, ["detector", "stream"], "left")
        .groupBy("event", "detector", "stream", "start")
        .agg(F.min(F.when(in_time, F.datediff("_day", "start"))).alias("days"))
        .withColumn("delay", F.when(F.col("days").isNull(), "not found").otherwise(F.format_string("%d days", "days")))
    )


def monitoring_run(
    rows: DataFrame, numeric: list[str], categorical: list[str], actual: str, predicted: str,
    ranged: tuple[str, float, float], thresholds: list[dict], drift_limit: float = 0.1,
) -> tuple[DataFrame, DataFrame]:
    """(metrics, alerts) per week, from rows labelled by seasonal_windows.

    Metrics are long: week, metric, value, with the metric names of the thresholds:
    drifted share, out of range, mae, mean error.
    """
    ref = F.col("is_reference")
    share = drifted_share(column_drift(rows, ["week"], numeric, categorical, ref, drift_limit), ["week"])
    m = regression_metrics(actual, predicted)
    column, lo, hi = ranged
    current = rows.filter(~ref).groupBy("week").agg(
        out_of_range(column, lo, hi).cast("double").alias("out of range"),
        m["mae"].alias("mae"),
        m["mean_error"].alias("mean error"),
    )
    wide = share.withColumnRenamed("drifted_share", "drifted share").join(current, "week")
    metrics = wide.unpivot(["week"], ["drifted share", "out of range", "mae", "mean error"], "metric", "value")
    return metrics, threshold_alerts(metrics, thresholds)
