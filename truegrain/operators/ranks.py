"""Running totals, exact quantiles and tail ranks that never put one key into one task.

Rows are first reduced to (key, value, weight). While the largest key has at most TASK_ROWS rows,
a plain window does the rest. Beyond that, values are cut into buckets at approximate quantiles of
the reduced rows, so a bucket holds about 1/buckets of them whatever the key is. A window inside
(key, bucket) plus the offset of the earlier buckets gives the exact running total: the approximate
cut points only decide who does the work, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truegrain.session import cut_lineage, materialize

BUCKETS = 256
TASK_ROWS = 4_000_000


def value_counts(df: DataFrame, keys: list[str], value: str, **weights: Column) -> DataFrame:
    """One row per key and distinct non-NULL value; weights default to the row count `n`."""
    aggs = weights or {"n": F.lit(1)}
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(*[F.sum(expr).alias(name) for name, expr in aggs.items()])
    )


def heavy(df: DataFrame, keys: list[str], limit: int = TASK_ROWS) -> bool:
    """Whether some key holds more rows than one task should order. Counts are combined map-side."""
    if not keys:
        return df.count() > limit
    top = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return (top or 0) > limit


def with_bucket(df: DataFrame, order: str, buckets: int = BUCKETS) -> DataFrame:
    """Bucket number, which never falls as `order` rises. Only cut points visit the driver.

    Numbers and times are cut at approximate quantiles. Text is range-partitioned by Spark, whose
    partitions are the buckets; callers write the frame before they use it twice.
    """
    kind = df.schema[order].dataType.typeName()
    if kind in ("string", "binary", "boolean"):
        return df.repartitionByRange(buckets, order).withColumn("_bucket", F.spark_partition_id())
    points = [i / buckets for i in range(1, buckets)]
    number = F.col(order)
    if kind in ("date", "timestamp", "timestamp_ntz"):
        number = F.unix_micros(number.cast("timestamp"))
    value = number.cast("double")
    found = df.agg(F.percentile_approx(value, points, F.lit(20 * buckets))).first()[0] or []
    cuts = F.array(*[F.lit(float(c)) for c in sorted(set(found))]).cast("array<double>")
    return df.withColumn("_bucket", F.size(F.filter(cuts, lambda cut: cut < value)))


_COMBINE = {"sum": F.sum, "max": F.max, "min": F.min}


def running(
    df: DataFrame,
    keys: list[str],
    order: str,
    aggs: dict[str, tuple[str, str]],
    inclusive: bool = True,
    totals: bool = False,
    spread: bool | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Running sum/max/min by `order` inside `keys`; `order` must be unique inside a key.

    aggs maps an output name to (kind, input column). With `totals`, total_<name> is the
    aggregate over the whole key. An exclusive run leaves out the row itself (NULL or 0 at first).
    `spread` forces or forbids the bucketed form; by default the largest key decides.
    """
    if spread is None:
        spread = heavy(df, keys)
    if not spread:
        whole = Window.partitionBy(*keys)
        frame = whole.orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        out = [F.col(c) for c in df.columns]
        for name, (kind, col) in aggs.items():
            value = _COMBINE[kind](col).over(frame)
            out.append((F.coalesce(value, F.lit(0)) if kind == "sum" else value).alias(name))
            if totals:
                out.append(_COMBINE[kind](col).over(whole).alias(f"total_{name}"))
        return df.select(*out)
    rows = materialize(with_bucket(materialize(df, "running"), order, buckets), "bucketed")
    per_bucket = rows.groupBy(*keys, "_bucket").agg(
        *[_COMBINE[kind](col).alias(f"_part_{name}") for name, (kind, col) in aggs.items()]
    )
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    columns = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)] + [F.col("_bucket").alias("_b")]
    for name, (kind, _) in aggs.items():
        columns.append(_COMBINE[kind](f"_part_{name}").over(earlier).alias(f"_before_{name}"))
        if totals:
            columns.append(_COMBINE[kind](f"_part_{name}").over(whole).alias(f"total_{name}"))
    offsets = per_bucket.select(*columns)
    condition = F.col("_bucket") == F.col("_b")
    for i, k in enumerate(keys):
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = rows.join(offsets, condition)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order)
    frame = inside.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    out = [F.col(c) for c in df.columns]
    for name, (kind, col) in aggs.items():
        local = _COMBINE[kind](col).over(frame)
        before = F.col(f"_before_{name}")
        if kind == "sum":
            value = F.coalesce(before, F.lit(0)) + F.coalesce(local, F.lit(0))
        elif kind == "max":
            value = F.greatest(before, local)
        else:
            value = F.least(before, local)
        out.append(value.alias(name))
        if totals:
            out.append(F.col(f"total_{name}"))
    return joined.select(*out)


def quantiles(
    df: DataFrame, keys: list[str], value: str, points: dict[str, float], spread: bool | None = None
) -> DataFrame:
    """Exact quantiles per key with linear interpolation; NULLs are left out.

    The built-in aggregate keeps the distinct values of a key in one task, which is fine up to
    TASK_ROWS rows per key. Beyond that the ranks are built in buckets.
    """
    if spread is None:
        spread = heavy(df, keys)
    if not spread:
        return df.groupBy(*keys).agg(
            *[F.percentile(F.col(value).cast("double"), F.lit(p)).alias(name) for name, p in points.items()]
        )
    return _weighted_quantiles(value_counts(df, keys, value), keys, value, points)


def _weighted_quantiles(counts: DataFrame, keys: list[str], value: str, points: dict[str, float]) -> DataFrame:
    ranked = running(counts, keys, value, {"upto": ("sum", "n")}, totals=True, spread=True)
    aggs = []
    for name, p in points.items():
        place = F.lit(p) * (F.col("total_upto") - 1)
        low, high = F.floor(place), F.ceil(place)
        first = F.min(F.when(F.col("upto") > low, F.col(value)))
        second = F.min(F.when(F.col("upto") > high, F.col(value)))
        part = F.max(place - low)
        aggs.append((first + part * (second - first)).alias(name))
    return ranked.groupBy(*keys).agg(*aggs)


def medians(df: DataFrame, keys: list[str], value: str, name: str = "median", spread: bool | None = None):
    return quantiles(df, keys, value, {name: 0.5}, spread)


def median_and_mad(df: DataFrame, keys: list[str], value: str, spread: bool | None = None) -> DataFrame:
    """Per key the median and the median absolute deviation."""
    if spread is None:
        spread = heavy(df, keys)
    if not spread:
        middle = medians(df, keys, value, "median", spread=False)
        apart = join_back(df.select(*keys, value), middle, keys)
        return apart.groupBy(*keys).agg(
            F.max("median").alias("median"),
            F.percentile(F.abs(F.col(value) - F.col("median")).cast("double"), F.lit(0.5)).alias("mad"),
        )
    counts = materialize(value_counts(df, keys, value), "counts")
    middle = cut_lineage(_weighted_quantiles(counts, keys, value, {"median": 0.5}))
    gap = F.abs(F.col(value) - F.col("median"))
    gaps = join_back(counts, middle, keys).groupBy(*keys, gap.alias("_gap")).agg(F.sum("n").alias("n"))
    return join_back(middle, _weighted_quantiles(gaps, keys, "_gap", {"mad": 0.5}), keys)


def join_back(df: DataFrame, stats: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join one-row-per-key statistics back to the rows; NULL keys match each other."""
    if not keys:
        row = stats.select(F.struct(*stats.columns)).scalar()
        return df.withColumn("_row", row).select(
            *df.columns, *[F.col(f"_row.{c}").alias(c) for c in stats.columns]
        )
    renamed = stats
    condition = None
    for i, k in enumerate(keys):
        renamed = renamed.withColumnRenamed(k, f"_s{i}")
        same = F.col(k).eqNullSafe(F.col(f"_s{i}"))
        condition = same if condition is None else condition & same
    return df.join(renamed, condition, how).drop(*[f"_s{i}" for i in range(len(keys))])


def tail_ranks(df: DataFrame, value: str, keys: list[str] | None = None, spread: bool | None = None) -> DataFrame:
    """Per distinct value the left tail P(X <= x) and the right tail P(X >= x)."""
    keys = keys or []
    if spread is None:
        spread = heavy(df, keys)
    counts = value_counts(df, keys, value)
    ranked = running(counts, keys, value, {"upto": ("sum", "n")}, totals=True, spread=spread)
    return ranked.select(
        *keys,
        value,
        "n",
        (F.col("upto") / F.col("total_upto")).alias("left_tail"),
        ((F.col("total_upto") - F.col("upto") + F.col("n")) / F.col("total_upto")).alias("right_tail"),
    )


def ks_statistic(
    df: DataFrame, keys: list[str], value: str, is_reference: Column, spread: bool | None = None
) -> DataFrame:
    """Largest distance of the two empirical distribution functions, per key."""
    if spread is None:
        spread = heavy(df, keys)
    counts = value_counts(
        df,
        keys,
        value,
        n_ref=F.when(is_reference, 1).otherwise(0),
        n_cur=F.when(is_reference, 0).otherwise(1),
    )
    sums = {"ref": ("sum", "n_ref"), "cur": ("sum", "n_cur")}
    ranked = running(counts, keys, value, sums, totals=True, spread=spread)
    gap = F.abs(
        F.col("ref") / F.nullif(F.col("total_ref"), F.lit(0))
        - F.col("cur") / F.nullif(F.col("total_cur"), F.lit(0))
    )
    return ranked.groupBy(*keys).agg(F.max(gap).alias("ks"))
