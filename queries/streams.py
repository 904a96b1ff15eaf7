"""Streaming operators over the event table, drained once and compared with their batch twins."""

from pyspark.sql import functions as F

from queries import query
from queries.drift import PH_SQL, ratio_stream
from queries.retail import CTES, Retail
from truegrain.plans.contract import FieldRule, TableContract
from truegrain.session import load, scratch_path, tune
from truegrain.sources.readers import read_events
from truegrain.streaming import events as E


class RetailStream(Retail):
    """The retail view with the event table as a stream."""

    def _raw(self, name):
        if name != "events":
            return super()._raw(name)
        schema = load(self.spark, self.directory, name).schema
        return read_events(self.spark, self.directory, schema, glob="events.parquet")


def event_stream(spark, d):
    return E.with_event_time(RetailStream(tune(spark), d)._raw("events"), "ts")


@query("src_19_stream_events", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def src_19(spark, d):
    stream = event_stream(spark, d).select("event_id", "event_type", "ts")
    path = E.run_to_files(stream, "events")
    return E.read_back(spark, path, stream.schema).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("str_01_dedupe_resent", CTES + "SELECT DISTINCT event_id FROM pos_events")
def str_01(spark, d):
    stream = E.with_event_time(RetailStream(spark, d)["pos_events"], "event_time")
    out = E.dedupe_resent(stream, "event_id", "event_time").select("event_id")
    return E.read_back(spark, E.run_to_files(out, "dedupe"), out.schema)


CLASS_SQL = """CASE WHEN ingested_at < event_time THEN 'clock ahead' WHEN ingested_at - event_time < INTERVAL 60 SECOND THEN 'in order' WHEN ingested_at - event_time <= INTERVAL 1 HOUR THEN 'late' ELSE 'too late' END"""


@query("str_02_lateness_classes", CTES + f"SELECT {CLASS_SQL} AS lateness, count(*) AS n, sum(event_id)::BIGINT AS ids FROM pos_events GROUP BY 1")
def str_02(spark, d):
    stream = RetailStream(spark, d)["pos_events"].withColumn("lateness", E.lateness_class("event_time", "ingested_at"))
    kinds = ["clock ahead", "in order", "late", "too late"]
    paths = E.run_routed(stream, "lateness", {k: F.col("lateness") == k for k in kinds})
    parts = [E.read_back(spark, paths[k], stream.schema) for k in kinds]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("lateness").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query(
    "str_03_clock_skew",
    CTES + """, o AS (SELECT store_id, terminal_id, epoch_us(event_time) / 1e6::DOUBLE - epoch_us(ingested_at) / 1e6::DOUBLE AS off FROM pos_events)
    SELECT store_id, terminal_id, round(avg((off > 0)::INT), 9) AS share_ahead, round(median(off), 3) AS usual_offset, avg((off > 0)::INT) >= 0.5 AS skewed FROM o GROUP BY 1, 2""",
)
def str_03(spark, d):
    out = E.clock_skew(Retail(spark, d)["pos_events"], ["store_id", "terminal_id"], "event_time", "ingested_at")
    return out.select("store_id", "terminal_id", F.round("share_ahead", 9).alias("share_ahead"), F.round("usual_offset", 3).alias("usual_offset"), "skewed")


@query(
    "str_03_clock_repair",
    CTES + """SELECT count(*) AS n, count(*) FILTER (event_time > ingested_at) AS ahead_before, 0::BIGINT AS ahead_after FROM pos_events""",
)
def str_03_repair(spark, d):
    rows = Retail(spark, d)["pos_events"]
    skew = E.clock_skew(rows, ["store_id", "terminal_id"], "event_time", "ingested_at")
    fixed = E.repair_clock(rows.withColumn("_was", F.col("event_time")), skew, ["store_id", "terminal_id"], "event_time")
    return fixed.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("_was") > F.col("ingested_at")).alias("ahead_before"),
        F.count_if(F.col("event_time") > F.col("ingested_at")).alias("ahead_after"),
    )


def _metrics():
    return {"n": F.count(F.lit(1)), "mean": F.round(F.avg("value"), 6), "errors": F.count_if(F.col("event_type") == "error")}


def _windows(spark, d, **options):
    out = E.windowed_metrics(event_stream(spark, d), "ts", _metrics(), **options)
    back = E.run_latest(out, "windows", ["window_start", "window_end"])
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return back.select(stamp("window_start"), stamp("window_end"), *[c for c in back.columns if not c.startswith("window_")])


STAMPS = "strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end"


@query(
    "str_04_windowed_metrics",
    f"""WITH w AS (SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, user_id % 8 AS store, count(*) AS n, round(avg(value), 6) AS mean, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1, 2, 3)
    SELECT {STAMPS}, store, n, mean, errors FROM w""",
)
def str_04(spark, d):
    stream = event_stream(spark, d).withColumn("store", F.col("user_id") % 8)
    out = E.windowed_metrics(stream, "ts", _metrics(), keys=["store"])
    back = E.run_latest(out, "windows", ["window_start", "window_end", "store"])
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return back.select(stamp("window_start"), stamp("window_end"), "store", "n", "mean", "errors")


@query(
    "str_04_sliding_windows",
    f"""WITH h AS (SELECT ts, value, event_type, date_trunc('day', ts) + to_hours((12 * floor(hour(ts) / 12))::BIGINT) AS half FROM events),
    w AS (SELECT half - to_hours((12 * s)::BIGINT) AS window_start, value, event_type FROM h CROSS JOIN range(0, 2) t(s)),
    g AS (SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS n, round(avg(value), 6) AS mean, count(*) FILTER (event_type = 'error') AS errors FROM w GROUP BY 1)
    SELECT {STAMPS}, n, mean, errors FROM g""",
)
def str_04_sliding(spark, d):
    return _windows(spark, d, width="1 day", slide="12 hours")


@query(
    "str_04_session_windows",
    """WITH g AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
    s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM g), w AS (SELECT user_id, sid, count(*) AS n, max(ts) + INTERVAL 2 HOUR AS e FROM s GROUP BY 1, 2)
    SELECT user_id, n, count(*) AS sessions FROM w GROUP BY 1, 2""",
)
def str_04_session(spark, d):
    out = E.windowed_metrics(event_stream(spark, d), "ts", {"n": F.count(F.lit(1))}, keys=["user_id"], width="2 hours", session=True)
    back = E.run_latest(out, "sessions", ["user_id", "window_start", "window_end"], mode="complete")
    return back.groupBy("user_id", "n").agg(F.count(F.lit(1)).alias("sessions"))


EVENT_CONTRACT = TableContract(
    "event",
    (
        FieldRule("event_id", "bigint", required=True),
        FieldRule("event_type", allowed=("click", "view", "purchase", "error")),
        FieldRule("value", "double", required=True, above=0, maximum=40),
    ),
)


@query(
    "str_05_checked_stream",
    """SELECT 'good' AS part, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events WHERE event_type IN ('click', 'view', 'purchase', 'error') AND value > 0 AND value <= 40
    UNION ALL SELECT 'bad', count(*), sum(event_id)::BIGINT FROM events WHERE NOT (event_type IN ('click', 'view', 'purchase', 'error') AND value > 0 AND value <= 40)""",
)
def str_05(spark, d):
    stream = E.check_events(event_stream(spark, d), EVENT_CONTRACT)
    paths = E.run_routed(stream, "checked", {"good": F.col("reason").isNull(), "bad": F.col("reason").isNotNull()})
    count = lambda name: E.read_back(spark, paths[name], stream.schema).agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")
    ).select(F.lit(name).alias("part"), "n", "ids")
    return count("good").unionByName(count("bad"))


@query("str_06_page_hinkley_stream", PH_SQL)
def str_06(spark, d):
    """Daily series as files, then keyed state; equals the batch detector (see tests)."""
    path = scratch_path(tune(spark), "series")
    series = ratio_stream(spark, d).select("k", "day", "x")
    series.write.parquet(path)
    stream = read_events(spark, path, series.schema)
    out = E.page_hinkley_stream(stream, "k", "day", "x", 14, 0.1, 12.0)
    return E.read_back(spark, E.run_to_files(out, "alarms"), out.schema).select("k", "day")


LIMITS = [{"metric": "mean", "min": 9.5, "max": 10.5, "owner": "data"}, {"metric": "errors", "max": 60, "owner": "platform"}]


@query(
    "str_07_alert_stream",
    """WITH w AS (SELECT date_trunc('day', ts) AS window_start, round(avg(value), 6) AS mean, (count(*) FILTER (event_type = 'error'))::DOUBLE AS errors FROM events GROUP BY 1),
    c AS (SELECT * FROM w)
    SELECT strftime(window_start, '%Y-%m-%d') AS day, 'mean' AS metric, mean AS value, 'data' AS owner FROM c WHERE mean < 9.5 OR mean > 10.5
    UNION ALL SELECT strftime(window_start, '%Y-%m-%d'), 'errors', errors, 'platform' FROM c WHERE errors > 60""",
)
def str_07(spark, d):
    metrics = E.windowed_metrics(event_stream(spark, d), "ts", _metrics())
    latest = E.run_latest(metrics, "alerts", ["window_start"])
    alerts = E.alert_stream(latest, "window_start", ["mean", "errors"], LIMITS)
    return alerts.select(F.date_format("week", "yyyy-MM-dd").alias("day"), "metric", "value", "owner")
