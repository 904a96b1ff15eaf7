"""Aggregates and evaluation metrics over whole tables."""

from pyspark.sql import functions as F

from queries import query
from queries.predicates import documents, events, lineitem, orders, part, table
from queries.retail import CTES, Retail
from truegrain.operators import aggregates as A
from truegrain.operators import dependencies as D
from truegrain.operators import diff
from truegrain.operators.ranks import join_back, median_and_mad, quantiles

customer, labels = table("customer"), table("labels")


def r(c, digits=8):
    return F.round(c, digits)


@query(
    "agg_02_uniqueness",
    "SELECT round(count(DISTINCT l_orderkey) / count(*), 9) AS order_ratio, round(count(DISTINCT l_partkey) / count(*), 9) AS part_ratio FROM lineitem",
)
def agg_02(spark, d):
    return lineitem(spark, d).agg(r(A.uniqueness("l_orderkey"), 9).alias("order_ratio"), r(A.uniqueness("l_partkey"), 9).alias("part_ratio"))


@query("agg_02_uniqueness_approx", "SELECT count(*) AS rows, true AS close FROM lineitem")
def agg_02_approx(spark, d):
    """The sketch stays within 10 % of the exact ratio."""
    gap = F.abs(A.uniqueness_approx("l_orderkey") / A.uniqueness("l_orderkey") - 1)
    return lineitem(spark, d).agg(F.count(F.lit(1)).alias("rows"), (gap < 0.1).alias("close"))


@query(
    "agg_03_composite_uniqueness",
    CTES + """SELECT round(count(*) / sum(n), 9) AS line_ratio, (SELECT round(count(*) / sum(n), 9) FROM (SELECT zip, city, count(*) AS n FROM stores GROUP BY ALL)) AS store_ratio
    FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)""",
)
def agg_03(spark, d):
    stores = Retail(spark, d)["stores"].agg(r(A.uniqueness("zip", "city"), 9).alias("store_ratio"))
    lines = lineitem(spark, d).agg(r(A.uniqueness("l_orderkey", "l_linenumber"), 9).alias("line_ratio"))
    return lines.withColumn("store_ratio", stores.scalar())


@query(
    "agg_04_identical_share",
    "SELECT round(1 - (sum(n) - count(*)) / sum(n), 9) AS score FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey, l_quantity, l_discount, l_tax, l_returnflag)",
)
def agg_04(spark, d):
    return A.identical_share(lineitem(spark, d), ["l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag"]).select(r("score", 9).alias("score"))


@query(
    "agg_05_grid_completeness",
    """SELECT round(count(DISTINCT (o_orderdate::DATE, o_custkey % 50)) / (count(DISTINCT o_orderdate::DATE) * count(DISTINCT o_custkey % 50)), 9) AS score FROM orders""",
)
def agg_05(spark, d):
    grid = orders(spark, d).select(F.col("o_orderdate").cast("date").alias("day"), (F.col("o_custkey") % 50).alias("k"))
    return A.grid_completeness(grid, "day", "k").select(r("score", 9).alias("score"))


@query(
    "agg_05_missing_cells",
    """WITH seen AS (SELECT DISTINCT o_orderdate::DATE AS day, o_custkey % 50 AS k FROM orders)
    SELECT k, day FROM (SELECT DISTINCT k FROM seen) CROSS JOIN (SELECT DISTINCT day FROM seen) EXCEPT SELECT k, day FROM seen""",
)
def agg_05_cells(spark, d):
    grid = orders(spark, d).select(F.col("o_orderdate").cast("date").alias("day"), (F.col("o_custkey") % 50).alias("k"))
    return A.missing_cells(grid, "day", "k")


@query(
    "agg_08_group_mode",
    """SELECT l_suppkey, mode AS usual_part FROM (SELECT l_suppkey, l_partkey AS mode, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_partkey) AS place
    FROM lineitem GROUP BY 1, 2) WHERE place = 1""",
)
def agg_08(spark, d):
    return A.group_mode(lineitem(spark, d), ["l_suppkey"], "l_partkey", "usual_part")


@query(
    "agg_09_fd_confidence",
    """WITH c AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2)
    SELECT round(sum(top) / sum(total), 9) AS confidence FROM (SELECT max(n) AS top, sum(n) AS total FROM c GROUP BY l_returnflag)""",
)
def agg_09(spark, d):
    return D.confidence(lineitem(spark, d), "l_returnflag", "l_linestatus").select(r("confidence", 9).alias("confidence"))


FD_COLUMNS = ["store_id", "product_id", "product_name", "category", "unit", "supplier_id"]


def _fd_sql():
    parts = []
    for a in FD_COLUMNS:
        for b in FD_COLUMNS:
            if a != b and b != "unit":
                parts.append(
                    f"""SELECT '{a}' AS lhs, '{b}' AS rhs, sum(top) / sum(total) AS confidence, count(*) AS lhs_values,
                    (SELECT count(DISTINCT {b}) FROM deliveries) AS rhs_values
                    FROM (SELECT {a}, max(n) AS top, sum(n) AS total FROM (SELECT {a}, {b}, count(*) AS n FROM deliveries GROUP BY 1, 2) GROUP BY 1)"""
                )
    return f"{CTES}, pairs AS ({' UNION ALL '.join(parts)}) SELECT lhs, rhs, round(confidence, 9) AS confidence FROM pairs WHERE confidence >= 0.5 AND confidence < 1 AND lhs_values > 1 AND rhs_values > 1"


@query("agg_10_fd_mining", _fd_sql())
def agg_10(spark, d):
    found = D.mine(Retail(spark, d)["deliveries"], FD_COLUMNS, 0.5, ("unit",))
    return found.withColumn("confidence", r("confidence", 9))


@query(
    "agg_11_median_and_mad",
    """WITH m AS (SELECT l_suppkey, median(l_extendedprice) AS med FROM lineitem GROUP BY 1)
    SELECT l_suppkey, round(any_value(med), 6) AS median, round(median(abs(l_extendedprice - med)), 6) AS mad FROM lineitem JOIN m USING (l_suppkey) GROUP BY 1""",
)
def agg_11(spark, d):
    out = median_and_mad(lineitem(spark, d), ["l_suppkey"], "l_extendedprice")
    return out.select("l_suppkey", r("median", 6).alias("median"), r("mad", 6).alias("mad"))


@query(
    "agg_12_robust_z",
    """WITH m AS (SELECT event_type, median(value) AS med FROM events GROUP BY 1), s AS (SELECT event_type, median(abs(value - med)) AS mad FROM events JOIN m USING (event_type) GROUP BY 1)
    SELECT event_id, round(abs(value - med) / (mad + 0.05), 6) AS z FROM events JOIN m USING (event_type) JOIN s USING (event_type)""",
)
def agg_12(spark, d):
    from truegrain.operators.detect import robust_z

    return robust_z(events(spark, d), ["event_type"], "value").select("event_id", r("robust_z", 6).alias("z"))


@query(
    "agg_13_describe",
    """SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice), 4) AS mean, round(max(l_extendedprice), 4) AS max, round(quantile_cont(l_extendedprice, 0.1), 4) AS p10,
    round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90 FROM lineitem GROUP BY 1, 2""",
)
def agg_13(spark, d):
    out = A.describe(lineitem(spark, d), ["l_returnflag", "l_linestatus"], "l_extendedprice")
    return out.select("l_returnflag", "l_linestatus", *[r(c, 4).alias(c) for c in ("mean", "max", "p10", "p50", "p90")])


@query(
    "agg_14_category_share",
    """SELECT l_returnflag AS category, count(DISTINCT l_partkey) AS items, round(sum(l_extendedprice), 2) AS amount, round(sum(l_extendedprice) / (SELECT sum(l_extendedprice) FROM lineitem), 9) AS share FROM lineitem GROUP BY 1""",
)
def agg_14(spark, d):
    out = A.category_share(lineitem(spark, d), "l_returnflag", "l_partkey", F.col("l_extendedprice"))
    return out.select(F.col("l_returnflag").alias("category"), "items", r("amount", 2).alias("amount"), r("share", 9).alias("share"))


SIZED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
WIDTHS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6}


@query(
    "agg_15_table_sizes",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows, {WIDTHS[t]}::BIGINT AS columns FROM {t}" for t in SIZED),
)
def agg_15(spark, d):
    return A.table_sizes({t: table(t)(spark, d) for t in SIZED})


@query("agg_16_census", "SELECT event_type, user_id % 8 AS store, count(*) AS n FROM events GROUP BY 1, 2")
def agg_16(spark, d):
    return A.census(events(spark, d).withColumn("store", F.col("user_id") % 8), "event_type", "store")


@query(
    "agg_17_rates",
    CTES + "SELECT round(avg(promo::INT), 9) AS promo_share, (SELECT round(avg((on_hand_system = 0)::INT), 9) FROM inventory) AS empty_share FROM sales",
)
def agg_17(spark, d):
    t = Retail(spark, d)
    empty = t["inventory"].agg(r(A.share(F.col("on_hand_system") == 0), 9)).scalar()
    return t["sales"].agg(r(A.share(F.col("promo")), 9).alias("promo_share")).withColumn("empty_share", empty)


PRED = "(l_quantity * (1 + ((l_partkey % 7) - 3) * 0.05))"
PRED_COL = lambda: F.col("l_quantity") * (1 + ((F.col("l_partkey") % 7) - 3) * 0.05)


@query(
    "agg_18_regression_metrics",
    f"""SELECT strftime(l_shipdate, '%Y-%m') AS month, round(avg(abs({PRED} - l_quantity)), 8) AS mae, round(avg({PRED} - l_quantity), 8) AS mean_error,
    round(sum(abs({PRED} - l_quantity)) / sum(l_quantity), 8) AS wape, round(sum(abs({PRED} - l_quantity)) / sum({PRED}), 8) AS wape_by_pred FROM lineitem GROUP BY 1""",
)
def agg_18(spark, d):
    rows = lineitem(spark, d).withColumn("pred", PRED_COL())
    m = A.regression_metrics("l_quantity", "pred")
    by_pred = A.regression_metrics("l_quantity", "pred", "predicted")["wape"]
    return rows.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(
        *[r(c).alias(n) for n, c in m.items()], r(by_pred).alias("wape_by_pred")
    )


@query(
    "agg_19_ratio_heatmap",
    f"""SELECT l_suppkey % 10 AS store, {", ".join(f"round(sum(l_quantity) FILTER (month(l_shipdate) = {m}) / sum({PRED}) FILTER (month(l_shipdate) = {m}), 9) AS m{m:02d}" for m in range(1, 13))}
    FROM lineitem GROUP BY 1""",
)
def agg_19(spark, d):
    rows = lineitem(spark, d).withColumn("pred", PRED_COL()).withColumn("store", F.col("l_suppkey") % 10)
    period = F.concat(F.lit("m"), F.date_format("l_shipdate", "MM"))
    return A.ratio_heatmap(rows, "store", period, [f"m{m:02d}" for m in range(1, 13)], "l_quantity", "pred")


@query(
    "agg_19_before_after",
    f"""SELECT l_returnflag, round(sum(CASE WHEN l_shipdate < TIMESTAMP '1998-01-15' THEN l_quantity END) / sum(CASE WHEN l_shipdate < TIMESTAMP '1998-01-15' THEN {PRED} END), 8) AS ratio_before,
    round(sum(CASE WHEN l_shipdate >= TIMESTAMP '1998-02-01' THEN l_quantity END) / sum(CASE WHEN l_shipdate >= TIMESTAMP '1998-02-01' THEN {PRED} END), 8) AS ratio_after FROM lineitem GROUP BY 1""",
)
def agg_19_segments(spark, d):
    rows = lineitem(spark, d).withColumn("pred", PRED_COL())
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    parts = A.before_after("l_quantity", "pred", day, "1998-01-15", "1998-02-01")
    return rows.groupBy("l_returnflag").agg(*[r(c).alias(n) for n, c in parts.items()])


@query(
    "agg_20_interval_coverage",
    """SELECT l_returnflag, round(avg((l_quantity BETWEEN 5 + l_linenumber AND 40 + l_linenumber)::INT), 9) AS coverage, round(avg((40 + l_linenumber) - (5 + l_linenumber)), 9) AS width FROM lineitem GROUP BY 1""",
)
def agg_20(spark, d):
    low, high = 5 + F.col("l_linenumber"), 40 + F.col("l_linenumber")
    return lineitem(spark, d).groupBy("l_returnflag").agg(
        *[r(c, 9).alias(n) for n, c in A.interval_metrics("l_quantity", low, high).items()]
    )


@query(
    "agg_21_column_stats",
    "SELECT round(median(o_totalprice), 4) AS median, round(stddev_samp(o_totalprice), 4) AS stdev, max(o_totalprice) AS max FROM orders",
)
def agg_21(spark, d):
    return A.column_stats(orders(spark, d), "o_totalprice").select(r("median", 4).alias("median"), r("stdev", 4).alias("stdev"), "max")


SCORED = "(SELECT event_id AS id, round(value, 1) AS score, (event_id % 17 = 3 OR (value > 30 AND event_id % 2 = 0)) AS truth, event_type AS detector FROM events)"


def scored(spark, d):
    e, v = F.col("event_id"), F.col("value")
    return events(spark, d).select(
        e.alias("id"), F.round(v, 1).alias("score"), ((e % 17 == 3) | ((v > 30) & (e % 2 == 0))).alias("truth"), F.col("event_type").alias("detector")
    )


@query(
    "agg_22_detection_quality",
    f"""SELECT t AS threshold, count(*) FILTER (score >= t) AS found, count(*) FILTER (score >= t AND truth) AS "right",
    round(count(*) FILTER (score >= t AND truth) / count(*) FILTER (score >= t), 9) AS precision, round(count(*) FILTER (score >= t AND truth) / count(*) FILTER (truth), 9) AS recall
    FROM {SCORED} CROSS JOIN (VALUES (1.0::DOUBLE), (10.0::DOUBLE), (30.0::DOUBLE)) v(t) GROUP BY 1""",
)
def agg_22(spark, d):
    out = A.detection_quality(scored(spark, d), "score", F.col("truth"), [1.0, 10.0, 30.0])
    return out.select("threshold", "found", "right", r("precision", 9).alias("precision"), r("recall", 9).alias("recall"))


@query(
    "agg_23_precision_at_k",
    f"""WITH s AS (SELECT *, row_number() OVER (PARTITION BY detector ORDER BY score DESC, id) AS place, count(*) FILTER (truth) OVER (PARTITION BY detector) AS k FROM {SCORED})
    SELECT detector, k, count(*) FILTER (truth AND place <= k) AS hits, round(count(*) FILTER (truth AND place <= k) / k, 9) AS precision_at_k FROM s GROUP BY 1, 2""",
)
def agg_23(spark, d):
    out = A.precision_at_k(scored(spark, d), ["detector"], "score", "id", F.col("truth"))
    return out.withColumn("precision_at_k", r("precision_at_k", 9))


@query(
    "agg_24_average_precision",
    f"""WITH c AS (SELECT detector, score, count(*) AS n, count(*) FILTER (truth) AS t FROM {SCORED} GROUP BY 1, 2),
    w AS (SELECT *, sum(n) OVER (PARTITION BY detector ORDER BY score DESC) AS rn, sum(t) OVER (PARTITION BY detector ORDER BY score DESC) AS rt, sum(t) OVER (PARTITION BY detector) AS tt FROM c)
    SELECT detector, round(sum(t / tt * rt / rn), 9) AS average_precision FROM w GROUP BY 1""",
)
def agg_24(spark, d):
    out = A.average_precision(scored(spark, d), ["detector"], "score", F.col("truth"))
    return out.withColumn("average_precision", r("average_precision", 9))


@query(
    "agg_25_roc_auc",
    f"""WITH r AS (SELECT detector, truth, rank() OVER (PARTITION BY detector ORDER BY score) + (count(*) OVER (PARTITION BY detector, score) - 1) / 2 AS rk FROM {SCORED})
    SELECT detector, round((sum(rk) FILTER (truth) - count(*) FILTER (truth) * (count(*) FILTER (truth) + 1) / 2) / (count(*) FILTER (truth) * count(*) FILTER (NOT truth)), 9) AS auc FROM r GROUP BY 1""",
)
def agg_25(spark, d):
    out = A.roc_auc(scored(spark, d), ["detector"], "score", F.col("truth"))
    return out.withColumn("auc", r("auc", 9))


@query(
    "agg_26_frequent_tuples",
    "SELECT p_brand, p_type, count(*) AS support, count(*) >= 20 AS frequent FROM part GROUP BY 1, 2",
)
def agg_26(spark, d):
    return A.frequent_tuples(part(spark, d), ["p_brand", "p_type"], 20)


def changed_customers(spark, d):
    k = F.col("c_custkey")
    old = customer(spark, d)
    new = old.filter(k % 50 != 3).select(
        F.when(k % 40 == 1, k + 10_000_000).otherwise(k).alias("c_custkey"),
        F.when(k % 11 == 0, F.upper("c_name")).otherwise(F.col("c_name")).alias("c_name"),
        F.when(k % 13 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(k % 17 == 0, None).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    return old, new


NEW_CUSTOMERS = """SELECT CASE WHEN c_custkey % 40 = 1 THEN c_custkey + 10000000 ELSE c_custkey END AS c_custkey, CASE WHEN c_custkey % 11 = 0 THEN upper(c_name) ELSE c_name END AS c_name,
CASE WHEN c_custkey % 13 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 50 <> 3"""


@query(
    "agg_27_cell_diff",
    f"""WITH n AS ({NEW_CUSTOMERS}), j AS (SELECT o.c_custkey, o.c_name AS a1, n.c_name AS b1, o.c_acctbal AS a2, n.c_acctbal AS b2, o.c_mktsegment AS a3, n.c_mktsegment AS b3 FROM customer o JOIN n USING (c_custkey))
    SELECT c_custkey, 'c_name' AS "column", a1 AS old_value, b1 AS new_value FROM j WHERE a1 IS DISTINCT FROM b1
    UNION ALL SELECT c_custkey, 'c_acctbal', round(a2, 2)::VARCHAR, round(b2, 2)::VARCHAR FROM j WHERE a2 IS DISTINCT FROM b2
    UNION ALL SELECT c_custkey, 'c_mktsegment', a3, b3 FROM j WHERE a3 IS DISTINCT FROM b3""",
)
def agg_27(spark, d):
    old, new = changed_customers(spark, d)
    new = new.withColumn("c_acctbal", F.round("c_acctbal", 2))
    return diff.cell_diff(old, new, ["c_custkey"], ["c_name", "c_acctbal", "c_mktsegment"])


@query(
    "agg_28_row_diff",
    f"""WITH n AS ({NEW_CUSTOMERS}) SELECT c_custkey, 'removed' AS change FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM n)
    UNION ALL SELECT c_custkey, 'added' FROM n WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)""",
)
def agg_28(spark, d):
    return diff.row_diff(*changed_customers(spark, d), ["c_custkey"])


@query(
    "agg_29_distribution_vs_history",
    CTES + """SELECT n.store_id, n.unit, round(n.m / b.m, 8) AS ratio, n.store_id || ' ' || n.unit || ': mean is ' || printf('%.2f', n.m / b.m) || ' x the usual' AS message FROM
    (SELECT store_id, unit, avg(quantity) AS m FROM deliveries WHERE delivery_date >= DATE '1999-01-01' AND delivery_date < DATE '1999-04-01' GROUP BY 1, 2) n
    JOIN (SELECT store_id, unit, avg(quantity) AS m FROM deliveries WHERE delivery_date >= DATE '1998-01-01' AND delivery_date < DATE '1998-04-01' GROUP BY 1, 2) b USING (store_id, unit)
    WHERE n.m / b.m < 0.65 OR n.m / b.m > 1.35""",
)
def agg_29(spark, d):
    rows = Retail(spark, d)["deliveries"]
    span = lambda a, b: rows.filter((F.col("delivery_date") >= F.lit(a).cast("date")) & (F.col("delivery_date") < F.lit(b).cast("date")))
    out = A.distribution_problems(span("1999-01-01", "1999-04-01"), span("1998-01-01", "1998-04-01"), ["store_id", "unit"], "quantity")
    return out.withColumn("ratio", r("ratio"))


@query(
    "agg_30_missing_rows",
    CTES + """SELECT store_id, count(*) AS rows, (SELECT count(DISTINCT product_id) * count(DISTINCT date) FROM sales) AS expected FROM sales GROUP BY 1
    HAVING count(*) < 0.95 * (SELECT count(DISTINCT product_id) * count(DISTINCT date) FROM sales)""",
)
def agg_30(spark, d):
    return A.missing_rows(Retail(spark, d)["sales"], "store_id", "product_id", "date")


@query(
    "agg_31_status_crosstab",
    """SELECT o_custkey % 20 AS clerk, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P,
    round(count(*) FILTER (o_orderstatus = 'F') / count(*), 9) AS accept_rate FROM orders GROUP BY 1""",
)
def agg_31(spark, d):
    rows = orders(spark, d).withColumn("clerk", F.col("o_custkey") % 20)
    return A.status_crosstab(rows, "clerk", "o_orderstatus", ["F", "O", "P"], "F").withColumn("accept_rate", r("accept_rate", 9))


@query(
    "agg_32_alert_summary",
    """SELECT event_type, count(*) AS alerts, min(week) AS first, max(week) AS last FROM (SELECT event_type, date_trunc('week', ts)::DATE AS week, count(*) AS n FROM events GROUP BY 1, 2) WHERE n > 400 GROUP BY 1""",
)
def agg_32(spark, d):
    weekly = events(spark, d).groupBy("event_type", F.date_trunc("week", "ts").cast("date").alias("week")).agg(F.count(F.lit(1)).alias("n"))
    return A.alert_summary(weekly.filter("n > 400"), "event_type")


@query(
    "agg_33_weekly_kpis",
    CTES + """SELECT date_trunc('week', date)::DATE AS week, round(100 * sum(lost) / sum(quantity + lost), 8) AS lost_pct, round(100 * sum(waste) / greatest(sum(quantity), 1), 8) AS waste_pct,
    round(avg(abs(forecast - quantity)), 8) AS forecast_error, round(100 * avg((on_hand > 0 AND shelf <= 0)::INT), 8) AS phantom_pct
    FROM (SELECT c.date, quantity, lost, (mix % 3)::DOUBLE AS waste, (mix % 50)::DOUBLE AS forecast, on_hand_system AS on_hand, (mix % 17 - 2)::DOUBLE AS shelf
          FROM sale_cells c JOIN truth USING (date, store_id, product_id) JOIN inventory USING (date, store_id, product_id)) GROUP BY 1""",
)
def agg_33(spark, d):
    t = Retail(spark, d)
    keys = ["date", "store_id", "product_id"]
    m = F.col("mix")
    rows = t["sale_cells"].join(t["truth"], keys).join(t["inventory"], keys).select(
        "date", "quantity", "lost", (F.col("quantity") + F.col("lost")).alias("demand"), (m % 3).cast("double").alias("waste"),
        (m % 50).cast("double").alias("forecast"), F.col("on_hand_system").alias("on_hand"), (m % 17 - 2).cast("double").alias("shelf"),
    )
    week = F.date_trunc("week", "date").cast("date")
    out = A.weekly_kpis(rows, week, "demand", "quantity", "lost", "waste", "forecast", "on_hand", "shelf")
    return out.select("week", *[r(c).alias(c) for c in ("lost_pct", "waste_pct", "forecast_error", "phantom_pct")])


@query(
    "agg_34_invalid_per_day",
    CTES + "SELECT date AS day, count(*) AS invalid, min(date) OVER () AS first_day FROM weather WHERE NOT temp_c BETWEEN -30 AND 45 GROUP BY date",
)
def agg_34(spark, d):
    return A.invalid_per_day(Retail(spark, d)["weather"], F.col("date"), F.col("temp_c").between(-30, 45))


@query(
    "agg_35_cause_context",
    """WITH c AS (SELECT event_type AS cause, user_id, hour(ts) AS hour FROM events),
    u AS (SELECT cause, user_id::VARCHAR AS v, row_number() OVER (PARTITION BY cause ORDER BY count(*) DESC, user_id::VARCHAR) AS place FROM c GROUP BY cause, user_id),
    h AS (SELECT cause, hour::VARCHAR AS v, row_number() OVER (PARTITION BY cause ORDER BY count(*) DESC, hour::VARCHAR) AS place FROM c GROUP BY cause, hour)
    SELECT c.cause, count(*) AS n, any_value(u.v) AS usual_user_id, any_value(h.v) AS usual_hour FROM c JOIN u ON c.cause = u.cause AND u.place = 1 JOIN h ON c.cause = h.cause AND h.place = 1 GROUP BY 1""",
)
def agg_35(spark, d):
    rows = events(spark, d).select(F.col("event_type").alias("cause"), "user_id", F.hour("ts").alias("hour"))
    return A.cause_context(rows, "cause", ["user_id", "hour"])
