"""Ordered operators on daily series and whole tables."""

from pyspark.sql import functions as F

from queries import query
from queries.predicates import events, lineitem, orders, part
from queries.retail import CTES, Retail
from truegrain.operators import ranks, sampling
from truegrain.operators import windows as W


@query(
    "win_01_duplicates_beyond_first",
    """SELECT event_id, user_id, event_type, v FROM (SELECT event_id, user_id, event_type, round(value) AS v FROM events)
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type, v ORDER BY event_id) > 1""",
)
def win_01(spark, d):
    rows = events(spark, d).select("event_id", "user_id", "event_type", F.round("value").alias("v"))
    return W.duplicates_beyond_first(rows, ["user_id", "event_type", "v"], ["event_id"])


@query(
    "win_02_repeats_by_entry_time",
    CTES + """SELECT delivery_id FROM deliveries QUALIFY row_number() OVER (PARTITION BY store_id, product_id, delivery_date, quantity ORDER BY entered_at, delivery_id) > 1""",
)
def win_02(spark, d):
    keys = ["store_id", "product_id", "delivery_date", "quantity"]
    return W.duplicates_beyond_first(Retail(spark, d)["deliveries"], keys, ["entered_at", "delivery_id"]).select("delivery_id")


@query(
    "win_03_duplicate_members",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1",
)
def win_03(spark, d):
    rows = lineitem(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return W.duplicate_members(rows, ["l_orderkey", "l_linenumber"])


DAILY_SQL = "(SELECT l_suppkey AS k, l_shipdate::DATE AS day, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2)"


def daily(spark, d):
    return W.daily_series(
        lineitem(spark, d).withColumnRenamed("l_suppkey", "k"), ["k"], F.col("l_shipdate").cast("date"), F.sum("l_quantity")
    )


@query("win_04_previous_value", f"SELECT k, day, round(value, 4) AS value, round(lag(value) OVER (PARTITION BY k ORDER BY day), 4) AS previous FROM {DAILY_SQL}")
def win_04(spark, d):
    out = W.previous_value(daily(spark, d), ["k"], "day", "value", "previous")
    return out.select("k", "day", F.round("value", 4).alias("value"), F.round("previous", 4).alias("previous"))


Z_SQL = f"""z AS (SELECT k, day, (value - m) / s AS z, row_number() OVER (PARTITION BY k ORDER BY day) AS i FROM {DAILY_SQL}
JOIN (SELECT k, avg(value) AS m, stddev_samp(value) AS s FROM {DAILY_SQL} WHERE day < DATE '1998-01-01' GROUP BY 1) USING (k))"""


def z_series(spark, d):
    return W.z_by_reference(daily(spark, d), ["k"], "value", F.col("day") < F.lit("1998-01-01").cast("date"))


@query(
    "win_05_cusum",
    f"""WITH RECURSIVE {Z_SQL}, c AS (SELECT k, i, day, 0.0::DOUBLE AS cusum FROM z WHERE i = 1
    UNION ALL SELECT z.k, z.i, z.day, greatest(0.0, c.cusum + z.z - 0.5) FROM c JOIN z ON z.k = c.k AND z.i = c.i + 1)
    SELECT k, day, round(cusum, 5) AS cusum, round(cusum, 5) > 5 AS alarm FROM c""",
)
def win_05(spark, d):
    out = W.cusum(z_series(spark, d), ["k"], "day")
    c = F.round("cusum", 5)
    return out.select("k", "day", c.alias("cusum"), (c > 5).alias("alarm"))


@query("win_06_sigma_rule", f"WITH {Z_SQL} SELECT k, day, round(z, 6) AS z FROM z WHERE z > 3")
def win_06(spark, d):
    return z_series(spark, d).filter(W.sigma_rule()).select("k", "day", F.round("z", 6).alias("z"))


@query(
    "win_07_first_alarm",
    f"""WITH {Z_SQL}, e AS (SELECT DISTINCT k, DATE '1999-01-01' + (k % 300)::INT AS start FROM z)
    SELECT e.k, e.start, min(day) AS first_alarm, min(day) - start AS delay_days FROM e LEFT JOIN z ON z.k = e.k AND z.z > 3 AND day >= start AND day <= start + 60 GROUP BY 1, 2""",
)
def win_07(spark, d):
    z = z_series(spark, d)
    starts = z.select("k").distinct().withColumn("start", F.date_add(F.lit("1999-01-01").cast("date"), (F.col("k") % 300).cast("int")))
    out = W.first_alarm(z.filter(W.sigma_rule()), starts, ["k"], "day", "start")
    return out.withColumn("delay_days", F.col("delay_days").cast("bigint"))


@query(
    "win_08_mean_of_next_days",
    f"SELECT k, day, round(avg(value) OVER (PARTITION BY k ORDER BY day RANGE BETWEEN CURRENT ROW AND INTERVAL 13 DAY FOLLOWING), 6) AS next_14 FROM {DAILY_SQL}",
)
def win_08(spark, d):
    return W.mean_of_next_days(daily(spark, d), ["k"], "day", "value").select("k", "day", F.round("next_14", 6).alias("next_14"))


FACTOR = "(1 + (isodow(day) - 1) * 0.1)"


@query(
    "win_09_trailing_forecast",
    f"""WITH s AS (SELECT k, day, value, {FACTOR} AS f, (dayofyear(day) + k) % 5 AS stock FROM {DAILY_SQL}),
    w AS (SELECT *, count(*) OVER t AS n, avg(value / f) OVER t AS plain, avg(CASE WHEN stock > 0 THEN value / f END) OVER t AS censored, coalesce(lead(f) OVER (PARTITION BY k ORDER BY day), f) AS nf
          FROM s WINDOW t AS (PARTITION BY k ORDER BY day ROWS BETWEEN 27 PRECEDING AND CURRENT ROW))
    SELECT k, day, CASE WHEN n = 28 THEN round(plain * nf, 6) END AS plain, CASE WHEN n = 28 THEN round(coalesce(censored, plain) * nf, 6) END AS censored FROM w""",
)
def win_09(spark, d):
    s = daily(spark, d).withColumn("f", 1 + F.weekday("day") * F.lit(0.1)).withColumn("stock", (F.dayofyear("day") + F.col("k")) % 5)
    plain = W.trailing_forecast(s, ["k"], "day", "value", "f").withColumnRenamed("forecast", "plain")
    both = W.trailing_forecast(plain, ["k"], "day", "value", "f", "stock").withColumnRenamed("forecast", "censored")
    return both.select("k", "day", F.round("plain", 6).alias("plain"), F.round("censored", 6).alias("censored"))


@query(
    "win_10_quiet_runs",
    f"""WITH s AS (SELECT k, day, value < 60 AS q FROM {DAILY_SQL}),
    g AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY day) - row_number() OVER (PARTITION BY k, q ORDER BY day) AS island FROM s),
    r AS (SELECT *, row_number() OVER (PARTITION BY k, q, island ORDER BY day) AS n FROM g)
    SELECT k, day, CASE WHEN q THEN n ELSE 0 END AS run_day, q AND n % 3 = 0 AS recount FROM r""",
)
def win_10(spark, d):
    out = W.quiet_runs(daily(spark, d), ["k"], "day", F.col("value") < 60)
    return out.select("k", "day", F.col("run_day").cast("bigint").alias("run_day"), "recount")


@query(
    "win_11_rank_of_record",
    "SELECT o_orderkey, round(o_totalprice, 2) AS price, rank() OVER (ORDER BY o_totalprice DESC) AS rank FROM orders",
)
def win_11(spark, d):
    rows = orders(spark, d)
    ranked = sampling.rank_table(rows, "o_totalprice").select("o_totalprice", "rank")
    return rows.join(ranked, "o_totalprice").select("o_orderkey", F.round("o_totalprice", 2).alias("price"), "rank")


@query(
    "win_12_tail_ranks",
    """WITH c AS (SELECT event_type, value, count(*) AS n FROM events GROUP BY 1, 2), w AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY value) AS upto, sum(n) OVER (PARTITION BY event_type) AS t FROM c)
    SELECT event_type, value, n, round(upto / t, 9) AS left_tail, round((t - upto + n) / t, 9) AS right_tail FROM w""",
)
def win_12(spark, d):
    out = ranks.tail_ranks(events(spark, d), "value", ["event_type"])
    return out.select("event_type", "value", "n", F.round("left_tail", 9).alias("left_tail"), F.round("right_tail", 9).alias("right_tail"))
