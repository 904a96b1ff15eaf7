"""Learned models: past repairs, forecasts, backtests, learning curves, intervals."""

import datetime as dt

from pyspark.sql import functions as F

from queries import query
from queries.predicates import events, lineitem
from queries.retail import CTES, Retail
from truegrain.operators import detect, drift, forecast
from truegrain.operators.aggregates import interval_metrics, regression_metrics, roc_auc
from truegrain.operators.inject import checkout_errors, unit_switch
from truegrain.operators.repair import repair_units
from truegrain.operators.sampling import top_share

CATEGORICAL, NUMERIC = ["terminal", "product"], ["hour", "quantity", "price"]


def checkout(spark, d):
    """Events as checkout lines; some terminals, products and hours are wrong more often."""
    e = F.col("event_id")
    rows = events(spark, d).select(
        e.alias("line_id"), F.col("ts").cast("date").alias("day"), (F.col("user_id") % 20).alias("terminal"),
        (F.col("user_id") % 13).alias("product"), F.hour("ts").alias("hour"), F.round("value", 2).alias("quantity"),
        F.col("value").alias("price"),
    )
    turn = F.col("line_id") % 10
    bad = (F.col("terminal") == 3) & (turn < 8)
    return checkout_errors(rows, "quantity", bad, (F.col("product") == 4) & (turn < 6), (F.col("hour") == 5) & (turn < 5))


def _split(rows):
    cut = F.lit("2024-01-21").cast("date")
    return rows.filter(F.col("day") < cut), rows.filter(F.col("day") >= cut)


def _learned(spark, d):
    past, new = _split(checkout(spark, d))
    model = detect.learn_from_repairs(past, "was_corrected", CATEGORICAL, NUMERIC, rounds=8)
    return model, new


@query("ml_09_learn_from_repairs")
def ml_09(spark, d):
    """AUC on later lines, and what checking the top 5 % finds."""
    model, new = _learned(spark, d)
    scored = detect.score_new_rows(model, new, CATEGORICAL).withColumn("p", F.round("p", 6))
    top = top_share(scored, 0.05, "p", "line_id")
    found = top.agg(F.count(F.lit(1)).alias("checked"), F.count_if("was_corrected").alias("found"))
    auc = roc_auc(scored, [], "p", F.col("was_corrected")).select(F.round("auc", 4)).scalar()
    return found.withColumn("auc", auc)


@query("ml_10_permutation_importance")
def ml_10(spark, d):
    model, new = _learned(spark, d)
    out = detect.permutation_importance(model, new, "line_id", "was_corrected", CATEGORICAL, NUMERIC)
    return out.withColumn("importance", F.round("importance", 4))


def store_days(spark, d):
    """Daily sales per store with weather and promotion share, as a forecasting table."""
    t = Retail(spark, d)
    daily = t["sales"].groupBy("date", "store_id").agg(F.sum("quantity").alias("quantity"), F.avg(F.col("promo").cast("int")).alias("promo"))
    temp = F.dayofyear("date") * 7 % 50 - 10
    return forecast.add_calendar(daily.withColumn("temp_c", temp.cast("double")), "date")


SPEC = forecast.ForecastSpec("date", "quantity", ("store_id", "weekday"), ("year_sin", "year_cos", "promo", "temp_c"), rounds=8, max_bins=32)
LINEAR = forecast.ForecastSpec("date", "quantity", ("store_id", "weekday"), ("year_sin", "year_cos", "promo", "temp_c"), learner="linear")


@query("dr_10_forecast_model")
def dr_10(spark, d):
    rows = store_days(spark, d)
    cut = F.lit("2000-01-01").cast("date")
    model = forecast.train(rows.filter(F.col("date") < cut), SPEC)
    scored = model.predict(rows.filter(F.col("date") >= cut))
    m = regression_metrics("quantity", "pred")
    return scored.groupBy("store_id").agg(F.count(F.lit(1)).alias("days"), *[F.round(c, 4).alias(n) for n, c in m.items()])


def _backtests(spark, d):
    """Stores 7 and 8 report pounds from September on; errors are measured against the true sales."""
    switched = F.col("store_id").isin(7, 8)
    rows = store_days(spark, d).withColumn("truth", F.col("quantity")).withColumn(
        "quantity", unit_switch("quantity", "date", "2000-09-01", 2.20462, 0.0, switched)
    )
    rows = forecast.materialize(rows, "store-days")
    pounds = switched & (F.col("date") >= F.lit("2000-09-01").cast("date"))
    repaired = repair_units(rows, [("quantity", pounds, 1 / 2.20462, 0.0)])
    start, end = dt.date(2000, 1, 1), dt.date(2000, 12, 31)
    policies = {
        "static": (rows, "never", None), "monthly, all data": (rows, "monthly", None), "monthly, 90 days": (rows, "monthly", 90),
        "on alarm, 90 days": (rows, "alarm", 90), "repaired, monthly, 90 days": (repaired, "monthly", 90),
    }
    for name, (table, when, window) in policies.items():
        predictions, retrains = forecast.backtest(table, LINEAR, start, end, when, window, detector=drift.PageHinkley(7, 0.02, 0.5))
        yield predictions.select(F.lit(name).alias("strategy"), "date", "truth", "pred"), name, len(retrains)


@query("dr_11_backtest")
def dr_11(spark, d):
    """Five retraining policies over one year: error of the first 8 and last 4 months, retrainings."""
    parts, counts = [], []
    for predictions, name, retrains in _backtests(spark, d):
        parts.append(predictions)
        counts.append((name, retrains))
    summary = forecast.strategy_summary(forecast.union_all(*parts), "strategy", "date", "truth", "pred")
    n = spark.createDataFrame(counts, "strategy string, retrains int")
    return summary.join(n, "strategy").select("strategy", F.round("wape_first", 4).alias("wape_first"), F.round("wape_last", 4).alias("wape_last"), "retrains")


@query(
    "dr_12_strategy_summary",
    CTES + """, p AS (SELECT s.strategy, date, quantity, quantity * (1 + (mix % 7 - 3) * 0.05 * s.f) AS pred FROM sale_cells CROSS JOIN (VALUES ('static', 2), ('monthly', 1)) s(strategy, f)),
    m AS (SELECT strategy, date_trunc('month', date) AS month, month(date) AS m, sum(abs(pred - quantity)) / sum(quantity) AS wape FROM p GROUP BY 1, 2, 3)
    SELECT strategy, round(avg(wape) FILTER (m <= 8), 9) AS wape_first, round(avg(wape) FILTER (m > 8), 9) AS wape_last FROM m GROUP BY 1""",
)
def dr_12(spark, d):
    cells = Retail(spark, d)["sale_cells"]
    pred = lambda f: F.col("quantity") * (1 + (F.col("mix") % 7 - 3) * 0.05 * f)
    rows = cells.select(F.lit("static").alias("strategy"), "date", "quantity", pred(2).alias("pred")).unionByName(
        cells.select(F.lit("monthly").alias("strategy"), "date", "quantity", pred(1).alias("pred"))
    )
    out = forecast.strategy_summary(rows, "strategy", "date", "quantity", "pred")
    return out.select("strategy", F.round("wape_first", 9).alias("wape_first"), F.round("wape_last", 9).alias("wape_last"))


def measured(spark, d):
    rows = lineitem(spark, d).groupBy(F.col("l_shipdate").cast("date").alias("day"), (F.col("l_suppkey") % 8).alias("store")).agg(
        F.sum("l_quantity").alias("truth"), F.avg("l_discount").alias("discount")
    )
    calendar = forecast.add_calendar(rows, "day")
    return forecast.add_measurement_error(calendar, "truth", 0.3, 0.2, "day", "store")


@query("dr_13_measurement_error")
def dr_13(spark, d):
    return measured(spark, d).select("day", "store", *[F.round(c, 6).alias(c) for c in ("clean", "imprecise", "inaccurate", "both")])


FEATURES = ["store", "weekday", "year_sin", "year_cos", "discount"]
CONDITIONS = ["clean", "imprecise", "inaccurate", "both"]


@query("dr_14_learning_curve")
def dr_14(spark, d):
    rows = measured(spark, d)
    cut = F.lit("2000-01-01").cast("date")
    out = forecast.learning_curve(rows.filter(F.col("day") < cut), rows.filter(F.col("day") >= cut), "day", [14, 28, 56, 112, 224, 366], FEATURES, CONDITIONS, "truth")
    return out.groupBy("condition", "size").agg(F.round(F.avg("mae"), 4).alias("mae"), F.round(F.avg("mean_error"), 4).alias("mean_error"))


@query("dr_14_boosting_curve")
def dr_14_boosting(spark, d):
    rows = forecast.materialize(measured(spark, d), "measured")
    cut = F.lit("2000-01-01").cast("date")
    spec = forecast.ForecastSpec("day", "truth", ("store", "weekday"), ("year_sin", "year_cos", "discount"), rounds=5, max_bins=32)
    out = forecast.boosting_curve(rows.filter(F.col("day") < cut), rows.filter(F.col("day") >= cut), spec, "day", [56, 366], ["clean", "both"], "truth")
    return out.select("condition", "size", F.round("mae", 4).alias("mae"), F.round("mean_error", 4).alias("mean_error"))


@query(
    "dr_15_conformal_intervals",
    CTES + """, p AS (SELECT store_id, date, quantity, quantity * (1 + (mix % 7 - 3) * 0.05) AS pred FROM sale_cells),
    b AS (SELECT store_id, quantile_cont(quantity - pred, 0.1) AS lo, quantile_cont(quantity - pred, 0.9) AS hi FROM p WHERE date < DATE '2000-01-01' GROUP BY 1)
    SELECT store_id, round(avg((quantity BETWEEN pred + lo AND pred + hi)::INT), 4) AS coverage, round(avg(hi - lo), 6) AS width FROM p JOIN b USING (store_id) WHERE date >= DATE '2000-01-01' GROUP BY 1""",
)
def dr_15(spark, d):
    pred = F.col("quantity") * (1 + (F.col("mix") % 7 - 3) * 0.05)
    rows = Retail(spark, d)["sale_cells"].withColumn("pred", pred)
    cut = F.lit("2000-01-01").cast("date")
    out = forecast.conformal_intervals(rows.filter(F.col("date") < cut), rows.filter(F.col("date") >= cut), ["store_id"], "quantity", "pred")
    m = interval_metrics("quantity", "low", "high")
    return out.groupBy("store_id").agg(F.round(m["coverage"], 4).alias("coverage"), F.round(m["width"], 6).alias("width"))
