"""Shares, uniqueness, completeness, error metrics and detector evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truegrain.functions.predicates import as_col
from truegrain.operators.ranks import heavy, join_back, quantiles, running, value_counts
from truegrain.session import materialize


def share(good: Column, null_is_bad: bool = False) -> Column:
    """Mean of a predicate; a NULL verdict is left out unless it counts as bad."""
    verdict = F.coalesce(good, F.lit(False)) if null_is_bad else good
    return F.avg(verdict.cast("int"))


def uniqueness(*cols: str) -> Column:
    """Distinct values over rows; a tuple with NULLs is a value as well."""
    what = F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)
    return F.count_distinct(what) / F.count(F.lit(1))


def uniqueness_approx(*cols: str) -> Column:
    what = F.col(cols[0]) if len(cols) == 1 else F.hash(*cols)
    return F.approx_count_distinct(what) / F.count(F.lit(1))


def identical_share(df: DataFrame, cols: list[str], name: str = "score") -> DataFrame:
    """1 minus the share of surplus copies of the same record."""
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg((1 - (F.sum("n") - F.count(F.lit(1))) / F.sum("n")).alias(name))


def grid_completeness(df: DataFrame, a: str, b: str, value: str | None = None, name: str = "score"):
    """Observed pairs over the full grid of both axes; with `value`, non-NULL readings over the grid.

    Reduced to distinct pairs first, so the distinct counts run on the small side.
    """
    filled = F.lit(1) if value is None else F.count(F.col(value))
    pairs = df.groupBy(a, b).agg(filled.alias("filled"))
    return pairs.agg(
        (F.sum("filled") / (F.count_distinct(a) * F.count_distinct(b))).alias(name)
    )


def missing_cells(df: DataFrame, axis: str, keys: str) -> DataFrame:
    """The empty cells of the (axis, key) grid, whatever its size.

    Axis values get consecutive places; a key's missing cells are the gaps between the places it has,
    so the work follows the cells seen and the cells missing. NULLs are no axis value.
    """
    seen = df.select(axis, keys).distinct()
    places = seen.select(axis).distinct().filter(F.col(axis).isNotNull())
    numbered = running(places.withColumn("_one", F.lit(1)), [], axis, {"_place": ("sum", "_one")}, spread=True)
    places = materialize(numbered.select(axis, "_place"), "places")
    last = places.agg(F.coalesce(F.max("_place"), F.lit(0)).alias("n")).scalar()
    taken = seen.join(places, axis, "left").select(keys, F.coalesce("_place", F.lit(0)).alias("_to"))
    ends = seen.select(keys).distinct().select(keys, (last + 1).alias("_to"))
    before = F.lag("_to", 1, 0).over(Window.partitionBy(keys).orderBy("_to"))
    gaps = taken.unionByName(ends).withColumn("_from", before + 1).filter(F.col("_from") < F.col("_to"))
    holes = gaps.select(keys, F.explode(F.sequence("_from", F.col("_to") - 1)).alias("_place"))
    return holes.join(places, "_place").select(keys, axis)


def group_mode(df: DataFrame, keys: list[str], value: str, name: str = "mode") -> DataFrame:
    """Most frequent value per key; the smallest one wins a tie. NULLs do not vote."""
    counts = value_counts(df, keys, value)
    return counts.groupBy(*keys).agg(
        F.min_by(value, F.struct((-F.col("n")).alias("n"), F.col(value).alias("v"))).alias(name)
    )


def describe(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    basic = df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.max(value).alias("max"))
    spread = quantiles(df, keys, value, {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    return join_back(basic, spread, keys)


def category_share(df: DataFrame, category: str, item: str, amount: Column) -> DataFrame:
    per = df.groupBy(category).agg(
        F.count_distinct(item).alias("items"), F.sum(amount).alias("amount")
    )
    total = df.agg(F.sum(amount)).scalar()
    return per.withColumn("_total", total).select(
        category, "items", "amount", (F.col("amount") / F.col("_total")).alias("share")
    )


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"),
            "rows",
            F.lit(len(df.columns)).cast("bigint").alias("columns"),
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def census(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def regression_metrics(actual, predicted, denominator: str = "actual") -> dict[str, Column]:
    """MAE, mean error and WAPE; the WAPE denominator is the actual or the predicted total."""
    a, p = as_col(actual), as_col(predicted)
    base = a if denominator == "actual" else p
    return {
        "mae": F.avg(F.abs(p - a)),
        "mean_error": F.avg(p - a),
        "wape": F.sum(F.abs(p - a)) / F.nullif(F.sum(base), F.lit(0.0)),
    }


def ratio(actual, predicted) -> Column:
    return F.sum(as_col(actual)) / F.nullif(F.sum(as_col(predicted)), F.lit(0.0))


def ratio_heatmap(df: DataFrame, key: str, period: Column, labels: list[str], actual, predicted):
    """Actual over predicted by key and period, one column per period label."""
    return (
        df.withColumn("_period", period)
        .groupBy(key)
        .pivot("_period", labels)
        .agg(F.round(ratio(actual, predicted), 9))
    )


def before_after(actual, predicted, date, end_before: str, start_after: str) -> dict[str, Column]:
    """Actual over predicted before one date and from another date on."""
    d, a, p = as_col(date), as_col(actual), as_col(predicted)

    def part(condition):
        return F.sum(F.when(condition, a)) / F.nullif(F.sum(F.when(condition, p)), F.lit(0.0))

    return {"ratio_before": part(d < end_before), "ratio_after": part(d >= start_after)}


def interval_metrics(actual, low, high) -> dict[str, Column]:
    a, lo, hi = as_col(actual), as_col(low), as_col(high)
    return {"coverage": F.avg(a.between(lo, hi).cast("int")), "width": F.avg(hi - lo)}


def column_stats(df: DataFrame, value: str) -> DataFrame:
    """Median, sample standard deviation and maximum as one row."""
    base = df.agg(F.stddev_samp(value).alias("stdev"), F.max(value).alias("max"))
    return join_back(base, quantiles(df, [], value, {"median": 0.5}), [])


def detection_quality(scored: DataFrame, score: str, truth: Column, thresholds) -> DataFrame:
    """Precision and recall at several thresholds in one pass."""
    rows = F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold")
    hits = scored.select(F.col(score).alias("s"), truth.cast("int").alias("t"), rows)
    return (
        hits.groupBy("threshold")
        .agg(
            F.sum((F.col("s") >= F.col("threshold")).cast("int")).alias("found"),
            F.sum(F.when(F.col("s") >= F.col("threshold"), F.col("t")).otherwise(0)).alias("right"),
            F.sum("t").alias("actual"),
        )
        .select(
            "threshold",
            "found",
            "right",
            (F.col("right") / F.nullif(F.col("found"), F.lit(0))).alias("precision"),
            (F.col("right") / F.nullif(F.col("actual"), F.lit(0))).alias("recall"),
        )
    )


def score_curve(scored: DataFrame, keys: list[str], score: str, truth: Column) -> DataFrame:
    """Per distinct score the counts of rows and of true errors at or above it."""
    spread = heavy(scored, keys)
    counts = value_counts(scored, keys, score, n=F.lit(1), t=truth.cast("int"))
    flipped = counts.withColumn("_down", -F.col(score))
    sums = {"rows_above": ("sum", "n"), "true_above": ("sum", "t")}
    return running(flipped, keys, "_down", sums, totals=True, spread=spread)


def average_precision(scored: DataFrame, keys: list[str], score: str, truth: Column) -> DataFrame:
    """Sum over the distinct thresholds of (gain in recall) * precision."""
    curve = score_curve(scored, keys, score, truth)
    gain = F.col("t") / F.nullif(F.col("total_true_above"), F.lit(0))
    return curve.groupBy(*keys).agg(
        F.sum(gain * F.col("true_above") / F.col("rows_above")).alias("average_precision")
    )


def roc_auc(scored: DataFrame, keys: list[str], score: str, truth: Column) -> DataFrame:
    """Rank formula: a true error beats each lower-scored good row, and half of the tied ones."""
    curve = score_curve(scored, keys, score, truth)
    good = F.col("n") - F.col("t")
    good_total = F.col("total_rows_above") - F.col("total_true_above")
    good_below = good_total - (F.col("rows_above") - F.col("true_above"))
    wins = F.col("t") * (good_below + good / 2)
    pairs = F.max(F.col("total_true_above").cast("double") * good_total)
    return curve.groupBy(*keys).agg((F.sum(wins) / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def precision_at_k(scored: DataFrame, keys: list[str], score: str, row_id: str, truth: Column):
    """Share of true errors among the k best scores, k being the number of true errors.

    Rows are ranked by (score desc, id) without one task per key: the distinct score that holds
    rank k is found on counts, and only the rows of that one score are ordered by id.
    """
    curve = score_curve(scored, keys, score, truth)
    k = F.col("total_true_above")
    first = F.col("rows_above") - F.col("n")
    whole = curve.filter(F.col("rows_above") <= k).groupBy(*keys).agg(
        F.sum("t").alias("_sure"), F.max("total_true_above").alias("_k")
    )
    edge = curve.filter((first < k) & (F.col("rows_above") > k)).select(
        *keys, F.col(score).alias("_edge"), (k - first).alias("_need"), k.alias("_k2")
    )
    tied = join_back(
        scored.withColumn("_t", truth.cast("int")), edge.drop("_k2"), keys
    ).filter(F.col(score) == F.col("_edge"))
    ordered = running(
        tied.select(*keys, row_id, "_t", "_need", F.lit(1).alias("_one")),
        keys,
        row_id,
        {"_place": ("sum", "_one")},
    )
    extra = (
        ordered.filter(F.col("_place") <= F.col("_need"))
        .groupBy(*keys)
        .agg(F.sum("_t").alias("_sure"))
    )
    sizes = curve.groupBy(*keys).agg(F.max("total_true_above").alias("k"))
    hits = whole.select(*keys, "_sure").unionByName(extra).groupBy(*keys).agg(F.sum("_sure").alias("hits"))
    out = join_back(sizes, hits, keys, "left") if keys else join_back(sizes, hits, [])
    return out.select(
        *keys,
        "k",
        F.coalesce("hits", F.lit(0)).alias("hits"),
        (F.coalesce("hits", F.lit(0)) / F.nullif(F.col("k"), F.lit(0))).alias("precision_at_k"),
    )


def frequent_tuples(df: DataFrame, cols: list[str], min_support: int = 30) -> DataFrame:
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("support"))
    return counts.withColumn("frequent", F.col("support") >= min_support)


def batch_vs_history(batch: DataFrame, history: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Ratio of the mean of this batch to the mean of history; keys missing on a side drop out."""
    now = batch.groupBy(*keys).agg(F.avg(value).alias("now"))
    before = history.groupBy(*keys).agg(F.avg(value).alias("before"))
    return now.join(before, keys).withColumn("ratio", F.col("now") / F.nullif(F.col("before"), F.lit(0.0)))


def distribution_problems(batch, history, keys, value, tolerance: float = 0.35) -> DataFrame:
    r = batch_vs_history(batch, history, keys, value)
    return r.filter((F.col("ratio") < 1 - tolerance) | (F.col("ratio") > 1 + tolerance)).select(
        *keys,
        "ratio",
        F.format_string(
            "%s: mean is %.2f x the usual",
            F.concat_ws(" ", *[F.col(k).cast("string") for k in keys]),
            F.col("ratio"),
        ).alias("message"),
    )


def missing_rows(df: DataFrame, key: str, item: str, date: str, minimum: float = 0.95) -> DataFrame:
    """Keys with fewer rows than `minimum` of (all items x all dates)."""
    expected = df.agg((F.count_distinct(item) * F.count_distinct(date)).alias("e")).scalar()
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("expected", expected)
        .filter(F.col("rows") < F.lit(minimum) * F.col("expected"))
    )


def status_crosstab(df: DataFrame, person: str, status: str, statuses: list[str], accepted: str):
    table = df.groupBy(person).pivot(status, statuses).count().na.fill(0, statuses)
    total = sum((F.col(s) for s in statuses), F.lit(0))
    return table.withColumn("accept_rate", F.col(accepted) / F.nullif(total, F.lit(0)))


def alert_summary(alerts: DataFrame, *keys: str, when: str = "week") -> DataFrame:
    return alerts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("alerts"), F.min(when).alias("first"), F.max(when).alias("last")
    )


def weekly_kpis(df: DataFrame, week: Column, demand, sales, lost, waste, forecast, system, shelf):
    """Weekly business figures of a stock table in long form."""
    return (
        df.groupBy(week.alias("week"))
        .agg(
            (100 * F.sum(lost) / F.nullif(F.sum(demand), F.lit(0.0))).alias("lost_pct"),
            (100 * F.sum(waste) / F.greatest(F.sum(sales), F.lit(1.0))).alias("waste_pct"),
            F.avg(F.abs(as_col(forecast) - as_col(sales))).alias("forecast_error"),
            (100 * F.avg(((as_col(system) > 0) & (as_col(shelf) <= 0)).cast("int"))).alias("phantom_pct"),
        )
    )


def invalid_per_day(df: DataFrame, day: Column, valid: Column) -> DataFrame:
    """Range violations per day, with the first day any was seen."""
    bad = df.filter(~valid).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("invalid"))
    return bad.withColumn("first_day", F.min("day").over(Window.partitionBy()))


def cause_context(df: DataFrame, cause: str, context: list[str]) -> DataFrame:
    """Per cause the count and the most frequent value of each context column, in one shuffle chain."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val")) for c in context])
    )
    counts = df.select(cause, pairs.alias("p")).groupBy(cause, "p.col", "p.val").agg(
        F.count(F.lit(1)).alias("n")
    )
    modes = counts.groupBy(cause, "col").agg(
        F.min_by("val", F.struct((-F.col("n")).alias("n"), F.col("val").alias("v"))).alias("usual"),
        F.sum("n").alias("total"),
    )
    first = lambda c: F.max(F.when(F.col("col") == c, F.col("usual"))).alias(f"usual_{c}")
    return modes.groupBy(cause).agg(F.max("total").alias("n"), *[first(c) for c in context])
