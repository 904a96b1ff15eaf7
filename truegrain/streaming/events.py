"""Streaming twins of the operators: deduplication, lateness, windows, contracts and detectors.

Every function takes a streaming (or batch) DataFrame and returns one; the sinks are files in a
shared folder, written per micro-batch under the batch id so that a repeated batch replaces itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from truegrain.functions.predicates import as_col
from truegrain.operators.drift import PageHinkley
from truegrain.operators.ranks import join_back, medians
from truegrain.operators.validate import reason_text, row_failures, threshold_alerts
from truegrain.session import scratch_path


def with_event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need TIMESTAMP; files often hold TIMESTAMP_NTZ."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def dedupe_resent(stream: DataFrame, event_id: str, event_time: str, delay: str = "1 day") -> DataFrame:
    """Events sent again under the same id, dropped while the watermark keeps the id."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([event_id])


def lateness_class(event_time, arrival, in_order: str = "60 SECONDS", late: str = "1 HOURS") -> Column:
    gap = as_col(arrival) - as_col(event_time)
    return (
        F.when(gap < F.expr("INTERVAL 0 SECONDS"), "clock ahead")
        .when(gap < F.expr(f"INTERVAL {in_order}"), "in order")
        .when(gap <= F.expr(f"INTERVAL {late}"), "late")
        .otherwise("too late")
    )


def clock_skew(df: DataFrame, keys: list[str], event_time: str, arrival: str, alarm_share: float = 0.5) -> DataFrame:
    """Share of events from the future per device, and its usual offset in seconds."""
    offset = (F.unix_micros(F.col(event_time).cast("timestamp")) - F.unix_micros(F.col(arrival).cast("timestamp"))) / 1_000_000
    rows = df.select(*keys, offset.alias("offset"))
    share = rows.groupBy(*keys).agg(F.avg((F.col("offset") > 0).cast("int")).alias("share_ahead"))
    return join_back(share, medians(rows, keys, "offset", "usual_offset"), keys).withColumn(
        "skewed", F.col("share_ahead") >= alarm_share
    )


def repair_clock(df: DataFrame, skew: DataFrame, keys: list[str], event_time: str, hours: float = 1.0) -> DataFrame:
    """Move the events of skewed devices back by their offset, rounded to whole hours."""
    shift = F.round(F.col("usual_offset") / (3600 * hours)) * (3600 * hours)
    fixes = skew.filter("skewed").select(*keys, shift.cast("bigint").alias("_shift"))
    moved = F.col(event_time) - F.make_dt_interval(secs=F.coalesce("_shift", F.lit(0)))
    return join_back(df, fixes, keys, "left").withColumn(event_time, moved).drop("_shift")


def windowed_metrics(
    stream: DataFrame, event_time: str, metrics: dict[str, Column], keys: list[str] | None = None,
    width: str = "1 day", slide: str | None = None, delay: str = "1 hour", session: bool = False,
) -> DataFrame:
    """Quality metrics per tumbling, sliding or session window.

    In append mode a window appears once the watermark has passed its end; `run_latest` also gives
    the windows that are still open when a bounded source ends.
    """
    frame = F.session_window(event_time, width) if session else F.window(event_time, width, slide)
    out = stream.withWatermark(event_time, delay).groupBy(frame.alias("w"), *(keys or [])).agg(
        *[c.alias(n) for n, c in metrics.items()]
    )
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *(keys or []), *metrics)


def check_events(stream: DataFrame, contract) -> DataFrame:
    """Row checks of a contract are stateless: add `failures`, and `reason` where there are some."""
    flagged = stream.withColumn("failures", row_failures(stream, contract))
    return flagged.withColumn("reason", F.when(F.size("failures") > 0, reason_text()))


def alert_stream(metrics: DataFrame, when: str, names: list[str], thresholds: list[dict]) -> DataFrame:
    """Windowed metrics in long form against the static thresholds."""
    long = metrics.select(
        F.col(when).alias("week"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])).alias("m"),
    ).select("week", "m.metric", "m.value")
    return threshold_alerts(long, thresholds)


STATE = T.StructType(
    [T.StructField("numbers", T.ArrayType(T.DoubleType())), T.StructField("last", T.LongType()), T.StructField("late", T.LongType())]
)


def page_hinkley_stream(
    stream: DataFrame, key: str, day: str, value: str,
    min_instances: int = 14, delta: float = 1.0, threshold: float = 40.0, alpha: float = 0.9999,
) -> DataFrame:
    """(key, day, late_rows) per alarm, with keyed state that restarts after an alarm.

    Rows of one micro-batch are put in order by day; rows at or before the last day already seen
    are counted as late and not replayed. Expects one row per key and day.
    """
    schema = T.StructType([stream.schema[key], stream.schema[day], T.StructField("late_rows", T.LongType())])

    def step(keys: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        numbers, last, late = state.get if state.exists else (None, -(2**62), 0)
        test = PageHinkley(min_instances, delta, threshold, alpha, numbers)
        rows = pd.concat(list(batches)).sort_values("_order")
        alarms = []
        for order, when, x in zip(rows["_order"], rows[day], rows[value]):
            if order <= last:
                late += 1
                continue
            last = int(order)
            if test.update(float(x)):
                alarms.append((keys[0], when, late))
        state.update(([float(v) for v in test.state], last, late))
        yield pd.DataFrame(alarms, columns=[key, day, "late_rows"])

    ordered = stream.select(key, day, value, F.unix_date(F.col(day).cast("date")).cast("bigint").alias("_order"))
    return ordered.groupBy(key).applyInPandasWithState(step, schema, STATE, "append", GroupStateTimeout.NoTimeout)


def run_to_files(stream: DataFrame, name: str, partition: str | None = None, fmt: str = "parquet", folder: str | None = None) -> str:
    """Drain what is available into files, once, and return the folder."""
    spark = stream.sparkSession
    folder = folder or scratch_path(spark, name)
    writer = stream.writeStream.format(fmt).option("path", f"{folder}/data").option(
        "checkpointLocation", f"{folder}/checkpoint"
    ).outputMode("append").trigger(availableNow=True)
    if partition:
        writer = writer.partitionBy(partition)
    writer.start().awaitTermination()
    return f"{folder}/data"


def run_latest(stream: DataFrame, name: str, keys: list[str], mode: str = "update", folder: str | None = None) -> DataFrame:
    """Drain what is available and return the last result of each group, open windows included.

    Each micro-batch is written under its id, so a repeated batch replaces itself; a group's row of
    the latest batch counts. Session windows need mode "complete".
    """
    spark = stream.sparkSession
    folder = folder or scratch_path(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{folder}/data/batch={batch_id}")

    stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    rows = read_back(spark, f"{folder}/data", T.StructType([*stream.schema, T.StructField("_batch", T.LongType())]))
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*stream.columns), "_batch").alias("_row"))
    return last.select("_row.*")


def run_routed(stream: DataFrame, name: str, routes: dict[str, Column], folder: str | None = None) -> dict[str, str]:
    """Send each row of a micro-batch to the first route it fits, in one pass over the batch.

    A repeated batch overwrites its own files. Rows that fit no route are kept under `unrouted`.
    """
    spark = stream.sparkSession
    folder = folder or scratch_path(spark, name)
    label = lambda route: route.replace(" ", "_")

    def write(batch: DataFrame, batch_id: int) -> None:
        route = F.lit("unrouted")
        for r, condition in reversed(routes.items()):
            route = F.when(condition, label(r)).otherwise(route)
        batch.withColumn("_route", route).write.mode("overwrite").partitionBy("_route").parquet(
            f"{folder}/data/batch={batch_id}"
        )

    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    return {r: f"{folder}/data/*/_route={label(r)}" for r in [*routes, "unrouted"]}


def read_back(spark, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Files a stream has written; an empty frame where nothing was routed to that place."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.globStatus(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").format(fmt).load(path)
