"""Ordered operators. Series are reduced to one row per key and day before any window runs,
so a window holds at most one calendar, however many rows a key has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truegrain.operators.ranks import join_back


def duplicates_beyond_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """All rows of a duplicate group but the first by `order` (which must be unique).

    The first row per group is a partial aggregate; joining it back lets a hot key be split.
    """
    first = df.groupBy(*keys).agg(
        F.min(F.struct(*order)).alias("_first"), F.count(F.lit(1)).alias("_n")
    ).filter(F.col("_n") > 1)
    return (
        join_back(df, first, keys)
        .filter(F.struct(*order) > F.col("_first"))
        .drop("_first", "_n")
    )


def duplicate_members(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every member of a duplicate group, the first one included."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return join_back(df, groups, keys).drop("_n")


def duplicate_member_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows sit in duplicate groups: an aggregate of the group sizes, no join back."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("unexpected"),
        F.sum("n").alias("rows"),
    )


def previous_value(df: DataFrame, keys: list[str], date: str, value: str, name: str) -> DataFrame:
    """Value of the previous row per key by date; expects one row per key and day."""
    return df.withColumn(name, F.lag(value).over(Window.partitionBy(*keys).orderBy(date)))


def daily_series(df: DataFrame, keys: list[str], day: Column, value: Column) -> DataFrame:
    return df.groupBy(*keys, day.alias("day")).agg(value.alias("value"))


def z_by_reference(series: DataFrame, keys: list[str], value: str, is_reference: Column) -> DataFrame:
    """z by the mean and the sample deviation of the reference part."""
    stats = series.filter(is_reference).groupBy(*keys).agg(
        F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sd")
    )
    z = (F.col(value) - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0))
    return join_back(series, stats, keys).withColumn("z", z).drop("_mean", "_sd")


def cusum(series: DataFrame, keys: list[str], date: str, z: str = "z", k: float = 0.5) -> DataFrame:
    """One-sided CUSUM in closed form: the running sum minus its running minimum.

    The first row of a key has value 0 and its z is not added.
    """
    order = Window.partitionBy(*keys).orderBy(date)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.row_number().over(order) == 1, F.lit(0.0)).otherwise(F.col(z) - F.lit(k))
    return (
        series.withColumn("_step", step)
        .withColumn("_path", F.sum("_step").over(upto))
        .withColumn("cusum", F.col("_path") - F.min("_path").over(upto))
        .drop("_step", "_path")
    )


def sigma_rule(z: str = "z", limit: float = 3.0) -> Column:
    return F.col(z) > limit


def first_alarm(
    alarms: DataFrame, events: DataFrame, keys: list[str], date: str, start: str, within_days: int = 60
) -> DataFrame:
    """First alarm from the start of an event on, within a number of days; NULL delay if none."""
    a = alarms.select(*keys, F.col(date).alias("_alarm")).distinct()
    in_time = (F.col("_alarm") >= F.col(start)) & (
        F.col("_alarm") <= F.date_add(F.col(start), within_days)
    )
    return (
        events.join(a, keys, "left")
        .groupBy(*events.columns)
        .agg(F.min(F.when(in_time, F.col("_alarm"))).alias("first_alarm"))
        .withColumn("delay_days", F.datediff("first_alarm", start))
    )


def mean_of_next_days(series: DataFrame, keys: list[str], date: str, value: str, days: int = 14):
    """Mean over the day itself and the following ones, by date and not by row."""
    number = F.unix_date(F.col(date).cast("date"))
    frame = Window.partitionBy(*keys).orderBy(number).rangeBetween(0, days - 1)
    return series.withColumn(f"next_{days}", F.avg(value).over(frame))


def trailing_forecast(
    series: DataFrame, keys: list[str], date: str, sales: str, factor: str, stock: str | None = None,
    days: int = 28,
) -> DataFrame:
    """Forecast of the next day from the last `days` rows, normalised by a weekday factor.

    With `stock`, days the system saw empty are censored; a window of only such days falls back to
    the plain mean. The next weekday factor is that of the following row.
    """
    order = Window.partitionBy(*keys).orderBy(date)
    frame = order.rowsBetween(-(days - 1), 0)
    level = F.col(sales) / F.col(factor)
    plain = F.avg(level).over(frame)
    if stock is not None:
        plain = F.coalesce(F.avg(F.when(F.col(stock) > 0, level)).over(frame), plain)
    following = F.coalesce(F.lead(factor).over(order), F.col(factor))
    full = F.count(F.lit(1)).over(frame) == days
    return series.withColumn("forecast", F.when(full, plain * following))


def quiet_runs(series: DataFrame, keys: list[str], date: str, quiet: Column, length: int = 3):
    """Fire on every `length`-th consecutive quiet day (gaps and islands)."""
    order = Window.partitionBy(*keys).orderBy(date)
    flagged = series.withColumn("_q", F.coalesce(quiet, F.lit(False)))
    islands = flagged.withColumn("_all", F.row_number().over(order)).withColumn(
        "_island",
        F.col("_all") - F.row_number().over(Window.partitionBy(*keys, "_q").orderBy(date)),
    )
    run = F.row_number().over(Window.partitionBy(*keys, "_q", "_island").orderBy(date))
    return (
        islands.withColumn("run_day", F.when(F.col("_q"), run).otherwise(0))
        .withColumn("recount", (F.col("run_day") > 0) & (F.col("run_day") % length == 0))
        .drop("_q", "_all", "_island")
    )
