"""Drift detection and monitoring over orders, lines and events."""

from pyspark.sql import functions as F

from queries import query
from queries.predicates import events, orders
from queries.windows import DAILY_SQL, daily
from truegrain.operators import drift as X
from truegrain.operators import ranks
from truegrain.operators.aggregates import alert_summary
from truegrain.operators.joins import seasonal_windows

REF = "o_orderdate < TIMESTAMP '1998-01-01'"


def is_ref():
    return F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")


@query(
    "dr_01_psi",
    f"""WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) FILTER ({REF}) AS r, count(*) FILTER (NOT ({REF})) AS q FROM orders GROUP BY 1, 2),
    s AS (SELECT o_orderstatus, r / sum(r) OVER (PARTITION BY o_orderstatus) + 1e-4::DOUBLE AS p, q / sum(q) OVER (PARTITION BY o_orderstatus) + 1e-4::DOUBLE AS q FROM c)
    SELECT o_orderstatus, round(sum((q - p) * ln(q / p)), 9) AS psi FROM s GROUP BY 1""",
)
def dr_01(spark, d):
    return X.psi(orders(spark, d), ["o_orderstatus"], "o_orderpriority", is_ref()).withColumn("psi", F.round("psi", 9))


KS = """SELECT {key}, value, sum(r) OVER w / nullif(sum(r) OVER (PARTITION BY {key}), 0) AS fr, sum(q) OVER w / nullif(sum(q) OVER (PARTITION BY {key}), 0) AS fq
FROM (SELECT {key}, {value} AS value, count(*) FILTER ({ref}) AS r, count(*) FILTER (NOT ({ref})) AS q FROM {table} GROUP BY 1, 2) WINDOW w AS (PARTITION BY {key} ORDER BY value)"""


@query(
    "dr_02_ks_statistic",
    f"""SELECT o_orderpriority, round(max(abs(fr - fq)), 9) AS ks FROM ({KS.format(key="o_orderpriority", value="o_totalprice", ref=REF, table="orders")}) GROUP BY 1""",
)
def dr_02(spark, d):
    return ranks.ks_statistic(orders(spark, d), ["o_orderpriority"], "o_totalprice", is_ref()).withColumn("ks", F.round("ks", 9))


WELCH = f"""SELECT o_orderpriority, avg(o_totalprice) FILTER ({REF}) AS mr, var_samp(o_totalprice) FILTER ({REF}) / count(*) FILTER ({REF}) AS a, count(*) FILTER ({REF}) AS nr,
avg(o_totalprice) FILTER (NOT ({REF})) AS mc, var_samp(o_totalprice) FILTER (NOT ({REF})) / count(*) FILTER (NOT ({REF})) AS b, count(*) FILTER (NOT ({REF})) AS nc FROM orders GROUP BY 1"""


@query(
    "dr_03_welch",
    f"SELECT o_orderpriority, round((mr - mc) / sqrt(a + b), 7) AS t, round((a + b) * (a + b) / (a * a / (nr - 1) + b * b / (nc - 1)), 3) AS df FROM ({WELCH})",
)
def dr_03(spark, d):
    out = X.welch(orders(spark, d), ["o_orderpriority"], "o_totalprice", is_ref())
    return out.select("o_orderpriority", F.round("t", 7).alias("t"), F.round("df", 3).alias("df"))


@query("dr_03_welch_p_value")
def dr_03_p(spark, d):
    out = X.with_p_value(X.welch(orders(spark, d), ["o_orderpriority"], "o_totalprice", is_ref()))
    return out.select("o_orderpriority", F.round("p", 8).alias("p"))


@query("dr_04_mean_shift", f"SELECT o_orderpriority, round(mc - mr, 4) AS mean_shift FROM ({WELCH})")
def dr_04(spark, d):
    return X.welch(orders(spark, d), ["o_orderpriority"], "o_totalprice", is_ref()).select("o_orderpriority", F.round("mean_shift", 4).alias("mean_shift"))


WEEKS = """w AS (SELECT DATE '2000-01-03' + (i * 7)::INT AS week FROM range(0, 51) t(i)),
lab AS (SELECT week, o.*, o_orderdate::DATE < week AS ref FROM w JOIN orders o ON o_orderdate::DATE BETWEEN week AND week + 6 OR o_orderdate::DATE BETWEEN week - 378 AND week - 344)"""


def labelled(spark, d):
    return seasonal_windows(orders(spark, d), "o_orderdate", "2000-01-03", "2000-12-18")


@query(
    "dr_05_weekly_drift",
    f"""WITH {WEEKS}, k AS (SELECT week, max(abs(fr - fq)) AS ks FROM ({KS.format(key="week", value="o_totalprice", ref="ref", table="lab")}) GROUP BY 1),
    kl AS (SELECT week, max(abs(fr - fq)) AS ks_log FROM ({KS.format(key="week", value="ln(1 + o_totalprice)", ref="ref", table="lab")}) GROUP BY 1),
    m AS (SELECT week, avg(o_totalprice) FILTER (NOT ref) - avg(o_totalprice) FILTER (ref) AS shift FROM lab GROUP BY 1),
    c AS (SELECT week, o_orderpriority, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS q FROM lab GROUP BY 1, 2),
    s AS (SELECT week, r / nullif(sum(r) OVER (PARTITION BY week), 0) + 1e-4::DOUBLE AS p, q / nullif(sum(q) OVER (PARTITION BY week), 0) + 1e-4::DOUBLE AS q FROM c), x AS (SELECT week, sum((q - p) * ln(q / p)) AS psi FROM s GROUP BY 1)
    SELECT week, round(ks, 9) AS ks, round(ks_log, 9) AS ks_log, round(shift, 4) AS mean_shift, round(psi, 8) AS psi FROM k JOIN kl USING (week) JOIN m USING (week) JOIN x USING (week)""",
)
def dr_05(spark, d):
    out = X.weekly_drift(labelled(spark, d), "o_totalprice", "o_orderpriority", "o_totalprice")
    return out.select("week", F.round("ks", 9).alias("ks"), F.round("ks_log", 9).alias("ks_log"), F.round("mean_shift", 4).alias("mean_shift"), F.round("psi", 8).alias("psi"))


# a week without orders on one side has no distance (NULL), and is not called drifted
JS = """SELECT {key}, CASE WHEN count(p) > 0 AND count(q) > 0 THEN sqrt(greatest(sum(((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END) + (CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END)) / 2), 0)) END AS distance
FROM (SELECT {key}, r / nullif(sum(r) OVER (PARTITION BY {key}), 0) AS p, q / nullif(sum(q) OVER (PARTITION BY {key}), 0) AS q FROM (SELECT {key}, {value} AS value, count(*) FILTER ({ref}) AS r, count(*) FILTER (NOT ({ref})) AS q FROM {table} GROUP BY 1, 2)) GROUP BY 1"""
WASS = """SELECT {key}, sum(abs(fr - fq) * (nextv - value)) / any_value(sd) AS distance FROM (SELECT *, lead(value) OVER (PARTITION BY {key} ORDER BY value) AS nextv FROM ({ks})) JOIN (SELECT {key}, stddev_pop({value}) FILTER ({ref}) AS sd FROM {table} GROUP BY 1) USING ({key}) GROUP BY 1"""


def _columns_sql():
    wass = WASS.format(key="week", value="o_totalprice", ref="ref", table="lab", ks=KS.format(key="week", value="o_totalprice", ref="ref", table="lab"))
    js = lambda c: JS.format(key="week", value=c, ref="ref", table="lab")
    return f"""cols AS (SELECT week, 'o_totalprice' AS column_name, distance FROM ({wass}) UNION ALL SELECT week, 'o_orderpriority', distance FROM ({js("o_orderpriority")}) UNION ALL SELECT week, 'o_orderstatus', distance FROM ({js("o_orderstatus")}))"""


@query(
    "dr_06_column_drift",
    f"WITH {WEEKS}, {_columns_sql()} SELECT week, column_name, round(distance, 7) AS distance, coalesce(round(distance, 7) > 0.1, false) AS drifted FROM cols",
)
def dr_06(spark, d):
    out = X.column_drift(labelled(spark, d), ["week"], ["o_totalprice"], ["o_orderpriority", "o_orderstatus"], F.col("is_reference"))
    return out.select("week", "column_name", F.round("distance", 7).alias("distance"), "drifted")


@query("dr_06_drifted_share", f"WITH {WEEKS}, {_columns_sql()} SELECT week, round(avg(coalesce(distance > 0.1, false)::INT), 9) AS drifted_share FROM cols GROUP BY 1")
def dr_06_share(spark, d):
    cols = X.column_drift(labelled(spark, d), ["week"], ["o_totalprice"], ["o_orderpriority", "o_orderstatus"], F.col("is_reference"))
    return X.drifted_share(cols, ["week"]).withColumn("drifted_share", F.round("drifted_share", 9))


@query("dr_07_out_of_range", "SELECT event_type, count(*) FILTER (NOT value BETWEEN 0.5 AND 30) AS n FROM events GROUP BY 1")
def dr_07(spark, d):
    return events(spark, d).groupBy("event_type").agg(X.out_of_range("value", 0.5, 30).alias("n"))


RATIO_SQL = f"(SELECT k, day, value / 40 AS ratio FROM {DAILY_SQL})"


def ratio_stream(spark, d):
    ratios = daily(spark, d).withColumn("ratio", F.col("value") / 40)
    return X.scaled_ratio_stream(ratios, ["k"], "day", "ratio", F.col("day") < F.lit("1997-01-01").cast("date"))


X_SQL = f"""x AS (SELECT k, day, (ratio - 1) / greatest(coalesce(sr, so), 0.02) AS x FROM {RATIO_SQL} JOIN (SELECT k, stddev_samp(ratio) FILTER (day < DATE '1997-01-01') AS sr, stddev_samp(ratio) FILTER (day >= DATE '1997-01-01') AS so FROM {RATIO_SQL} GROUP BY 1) USING (k) WHERE day >= DATE '1997-01-01')"""


@query(
    "dr_08_first_page_hinkley",
    f"""WITH {X_SQL}, m AS (SELECT *, row_number() OVER o AS n, avg(x) OVER o AS mean FROM x WINDOW o AS (PARTITION BY k ORDER BY day)),
    s AS (SELECT *, sum(x - mean - 0.1) OVER o AS up, sum(x - mean + 0.1) OVER o AS down FROM m WINDOW o AS (PARTITION BY k ORDER BY day)),
    a AS (SELECT *, up - min(up) OVER o AS high, max(down) OVER o - down AS low FROM s WINDOW o AS (PARTITION BY k ORDER BY day))
    SELECT k, min(day) AS first_alarm FROM a WHERE n >= 14 AND (high > 12 OR low > 12) GROUP BY 1""",
)
def dr_08_first(spark, d):
    return X.first_page_hinkley(ratio_stream(spark, d), ["k"], "day", "x", 14, 0.1, 12.0)


PH_SQL = f"""WITH RECURSIVE {X_SQL}, q AS (SELECT k, day, x, row_number() OVER (PARTITION BY k ORDER BY day) AS i FROM x),
s AS (SELECT DISTINCT k, 0::BIGINT AS i, DATE '1900-01-01' AS day, 0::BIGINT AS n, 0::DOUBLE AS mean, 0::DOUBLE AS up, 0::DOUBLE AS down, 1e300::DOUBLE AS lo, -1e300::DOUBLE AS hi, false AS alarm FROM q
UNION ALL SELECT k, i, day, n, mean, up, down, least(lo, up), greatest(hi, down), n >= 14 AND (up - least(lo, up) > 12 OR greatest(hi, down) - down > 12)
FROM (SELECT k, i, day, n, mean, 0.9999::DOUBLE * up0 + (x - mean - 0.1::DOUBLE) AS up, 0.9999::DOUBLE * down0 + (x - mean + 0.1::DOUBLE) AS down, lo, hi
  FROM (SELECT q.k, q.i, q.day, q.x, CASE WHEN s.alarm THEN 1 ELSE s.n + 1 END AS n, CASE WHEN s.alarm THEN q.x ELSE s.mean + (q.x - s.mean) / (s.n + 1) END AS mean,
        CASE WHEN s.alarm THEN 0 ELSE s.up END AS up0, CASE WHEN s.alarm THEN 0 ELSE s.down END AS down0, CASE WHEN s.alarm THEN 1e300::DOUBLE ELSE s.lo END AS lo, CASE WHEN s.alarm THEN -1e300::DOUBLE ELSE s.hi END AS hi
        FROM s JOIN q ON q.k = s.k AND q.i = s.i + 1)))
SELECT k, day FROM s WHERE alarm"""


@query("dr_08_page_hinkley", PH_SQL)
def dr_08(spark, d):
    return X.page_hinkley(ratio_stream(spark, d), ["k"], "day", "x", 14, 0.1, 12.0)


@query(
    "dr_09_delay_summary",
    f"""WITH e AS (SELECT DISTINCT k, 'event ' || k AS event, DATE '1999-01-01' + (k % 300)::INT AS start FROM {DAILY_SQL}), al AS (SELECT k, day FROM {DAILY_SQL} WHERE value > 130)
    SELECT event, 'level' AS detector, e.k::VARCHAR AS stream, start, coalesce(min(day - start) || ' days', 'not found') AS delay FROM e LEFT JOIN al ON al.k = e.k AND day >= start AND day <= start + 60 GROUP BY 1, 2, 3, 4""",
)
def dr_09(spark, d):
    series = daily(spark, d)
    text = F.col("k").cast("string")
    alarms = series.filter("value > 130").select(F.lit("level").alias("detector"), text.alias("stream"), "day")
    found = series.select("k").distinct().select(
        F.concat(F.lit("event "), text).alias("event"), F.lit("level").alias("detector"), text.alias("stream"),
        F.date_add(F.lit("1999-01-01").cast("date"), (F.col("k") % 300).cast("int")).alias("start"),
    )
    return X.delay_summary(found, alarms).select("event", "detector", "stream", "start", "delay")


LIMITS = [
    {"metric": "drifted share", "max": 0.2, "owner": "data engineering"},
    {"metric": "out of range", "max": 0, "owner": "data engineering"},
    {"metric": "mae", "max": 20000.0, "owner": "forecasting"},
    {"metric": "mean error", "min": -3000.0, "max": 3000.0, "owner": "forecasting"},
]
ALERTS_SQL = f"""WITH {WEEKS}, {_columns_sql()}, m AS (SELECT week, 'drifted share' AS metric, avg(coalesce(distance > 0.1, false)::INT) AS value FROM cols GROUP BY 1
UNION ALL SELECT week, 'out of range', count(*) FILTER (NOT o_totalprice BETWEEN 1000 AND 499000)::DOUBLE FROM lab WHERE NOT ref GROUP BY 1
UNION ALL SELECT week, 'mae', avg(abs(round(o_totalprice, -5) - o_totalprice)) FROM lab WHERE NOT ref GROUP BY 1
UNION ALL SELECT week, 'mean error', avg(round(o_totalprice, -5) - o_totalprice) FROM lab WHERE NOT ref GROUP BY 1),
l AS (SELECT * FROM (VALUES ('drifted share', NULL, 0.2::DOUBLE, 'data engineering'), ('out of range', NULL, 0.0::DOUBLE, 'data engineering'), ('mae', NULL, 20000.0::DOUBLE, 'forecasting'), ('mean error', -3000.0::DOUBLE, 3000.0::DOUBLE, 'forecasting')) v(metric, lo, hi, owner)),
alerts AS (SELECT week, metric, round(value, 3) AS value, owner FROM m JOIN l USING (metric) WHERE value > hi OR value < lo)"""


def monitored(spark, d):
    rows = labelled(spark, d).withColumn("pred", F.round("o_totalprice", -5))
    return X.monitoring_run(rows, ["o_totalprice"], ["o_orderpriority", "o_orderstatus"], "o_totalprice", "pred", ("o_totalprice", 1000.0, 499000.0), LIMITS)


@query("dr_16_monitoring_alerts", f"{ALERTS_SQL} SELECT week, metric, value, owner FROM alerts")
def dr_16(spark, d):
    return monitored(spark, d)[1].select("week", "metric", F.round("value", 3).alias("value"), "owner")


@query("dr_16_alert_summary", f"{ALERTS_SQL} SELECT metric, owner, count(*) AS alerts, min(week) AS first, max(week) AS last FROM alerts GROUP BY 1, 2")
def dr_16_summary(spark, d):
    return alert_summary(monitored(spark, d)[1], "metric", "owner")
