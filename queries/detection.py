"""Outlier detection and broken patterns."""

from pyspark.sql import functions as F

from queries import query
from queries.predicates import events, part
from queries.retail import CTES, Retail
from queries.rules import error_log
from truegrain.operators import density
from truegrain.operators import dependencies as D
from truegrain.operators import detect as M
from truegrain.operators.diff import union_all
from truegrain.session import materialize

LOG = "sign(quantity) * ln(1 + abs(quantity))"
TYPICAL = f", base AS (SELECT *, {LOG} AS lq FROM deliveries), typical AS (SELECT store_id, product_id, median(lq) AS typical FROM base GROUP BY 1, 2)"


@query(
    "ml_01_context_features",
    f"{CTES}{TYPICAL} SELECT delivery_id, round(lq, 8) AS log_value, round(lq - typical, 8) AS deviation FROM base JOIN typical USING (store_id, product_id)",
)
def ml_01(spark, d):
    out = M.context_features(Retail(spark, d)["deliveries"], ["store_id", "product_id"], "quantity")
    return out.select("delivery_id", F.round("log_value", 8).alias("log_value"), F.round("deviation", 8).alias("deviation"))


@query(
    "ml_02_robust_z",
    f"""{CTES}{TYPICAL}, mads AS (SELECT store_id, product_id, median(abs(lq - typical)) AS mad FROM base JOIN typical USING (store_id, product_id) GROUP BY 1, 2)
    SELECT delivery_id, round(abs(lq - typical) / (mad + 0.05), 6) AS z FROM base JOIN typical USING (store_id, product_id) JOIN mads USING (store_id, product_id)""",
)
def ml_02(spark, d):
    from truegrain.functions.scalars import signed_log1p

    rows = Retail(spark, d)["deliveries"].withColumn("lq", signed_log1p("quantity"))
    return M.robust_z(rows, ["store_id", "product_id"], "lq").select("delivery_id", F.round("robust_z", 6).alias("z"))


@query(
    "ml_03_ecod",
    """WITH m AS (SELECT avg(value) AS mv, stddev_pop(value) AS sv, avg(user_id) AS mu, stddev_pop(user_id) AS su FROM events),
    k AS (SELECT avg(((value - mv) / sv) ** 3) AS kv, avg(((user_id - mu) / su) ** 3) AS ku FROM events, m),
    t AS (SELECT event_id, -ln(cume_dist() OVER (ORDER BY value)) AS lv, -ln(cume_dist() OVER (ORDER BY value DESC)) AS rv, -ln(cume_dist() OVER (ORDER BY user_id)) AS lu, -ln(cume_dist() OVER (ORDER BY user_id DESC)) AS ru FROM events)
    SELECT event_id, round(greatest(lv + lu, rv + ru, CASE WHEN kv < 0 THEN lv ELSE rv END + CASE WHEN ku < 0 THEN lu ELSE ru END), 6) AS ecod FROM t, k""",
)
def ml_03(spark, d):
    rows = events(spark, d).select("event_id", "value", "user_id")
    return M.ecod(rows, ["value", "user_id"]).select("event_id", F.round("ecod", 6).alias("ecod"))


@query("ml_04_isolation_forest")
def ml_04(spark, d):
    rows = M.context_features(Retail(spark, d)["deliveries"], ["store_id", "product_id"], "quantity")
    out = M.isolation_forest(rows.select("delivery_id", "log_value", "deviation"), "delivery_id", ["log_value", "deviation"])
    return out.select("delivery_id", F.round("isolation", 6).alias("isolation"))


@query("ml_05_local_outlier_factor")
def ml_05(spark, d):
    rows = events(spark, d).select("event_id", "event_type", "value")
    return M.lof(rows, "event_id", "value", ["event_type"], k=20).withColumn("lof", F.round("lof", 6))


@query(
    "ml_05_lof_several_features",
    """WITH p AS (SELECT p_partkey AS id, p_size::DOUBLE AS a, p_retailprice AS b FROM part WHERE p_size IS NOT NULL AND isfinite(p_retailprice)),
    near AS (SELECT p, q, d FROM (SELECT x.id AS p, y.id AS q, sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b)) AS d FROM p x JOIN p y ON x.id <> y.id) QUALIFY rank() OVER (PARTITION BY p ORDER BY d) <= 100),
    kth AS (SELECT p, max(d) AS kth FROM near GROUP BY p),
    density AS (SELECT near.p, 1 / (avg(greatest(kth, d)) + 1e-10) AS density FROM near JOIN kth ON q = kth.p GROUP BY near.p)
    SELECT near.p AS p_partkey, round(avg(o.density) / any_value(s.density), 6) AS lof FROM near JOIN density o ON q = o.p JOIN density s ON near.p = s.p GROUP BY near.p""",
)
def ml_05_several(spark, d):
    return density.lof(part(spark, d), "p_partkey", ["p_size", "p_retailprice"], k=100).withColumn("lof", F.round("lof", 6))


@query(
    "ml_06_fd_violations",
    CTES + """, u AS (SELECT product_id, product_name AS usual FROM (SELECT product_id, product_name, row_number() OVER (PARTITION BY product_id ORDER BY count(*) DESC, product_name) AS place FROM deliveries GROUP BY 1, 2) WHERE place = 1)
    SELECT delivery_id, product_id, product_name, usual FROM deliveries JOIN u USING (product_id) WHERE product_name <> usual""",
)
def ml_06(spark, d):
    return D.violations(Retail(spark, d)["deliveries"], "product_id", "product_name", ["delivery_id"])


@query(
    "ml_11_compare_detectors",
    """WITH s AS (SELECT event_id AS id, round(value) AS score, 'value' AS detector, (event_id % 19 = 4 OR value > 45) AS truth FROM events UNION ALL SELECT event_id, (user_id % 10)::DOUBLE, 'user', (event_id % 19 = 4 OR value > 45) FROM events),
    p AS (SELECT *, row_number() OVER (PARTITION BY detector ORDER BY score DESC, id) AS place, count(*) FILTER (truth) OVER (PARTITION BY detector) AS k FROM s),
    c AS (SELECT detector, score, count(*) AS n, count(*) FILTER (truth) AS t FROM s GROUP BY 1, 2),
    w AS (SELECT *, sum(n) OVER (PARTITION BY detector ORDER BY score DESC) AS rn, sum(t) OVER (PARTITION BY detector ORDER BY score DESC) AS rt, sum(t) OVER (PARTITION BY detector) AS tt FROM c),
    a AS (SELECT detector, sum(t / tt * rt / rn) AS ap FROM w GROUP BY 1)
    SELECT detector, max(k) AS k, count(*) FILTER (truth AND place <= k) AS hits, round(any_value(ap), 9) AS average_precision FROM p JOIN a USING (detector) GROUP BY 1""",
)
def ml_11(spark, d):
    e, v = F.col("event_id"), F.col("value")
    truth = (e % 19 == 4) | (v > 45)
    rows = events(spark, d)
    scores = rows.select(e.alias("id"), F.round(v).alias("score"), F.lit("value").alias("detector"), truth.alias("truth")).unionByName(
        rows.select(e.alias("id"), (F.col("user_id") % 10).cast("double").alias("score"), F.lit("user").alias("detector"), truth.alias("truth"))
    )
    out = M.compare_detectors(scores, "detector", "score", "id", F.col("truth"))
    return out.select("detector", "k", "hits", F.round("average_precision", 9).alias("average_precision"))


RAW, CONTEXT = ["quantity", "product", "weekday"], ["log_value", "deviation"]


@query("ml_11_detectors_on_deliveries")
def ml_11_deliveries(spark, d):
    """Robust z, isolation forest, ECOD and LOF against the log of injected errors, on raw and on contextual features."""
    t = Retail(spark, d).stored("deliveries")
    log = error_log(t).filter("table_name = 'deliveries'").select("row_id").distinct().withColumn("truth", F.lit(True))
    rows = M.context_features(t["deliveries"], ["store_id", "product_id"], "quantity").select(
        "delivery_id", "quantity", F.col("product_id").cast("double").alias("product"),
        F.dayofweek("delivery_date").cast("double").alias("weekday"), *CONTEXT,
    )
    rows = rows.join(log, F.col("delivery_id").cast("string") == F.col("row_id"), "left").drop("row_id")
    rows = materialize(rows.withColumn("truth", F.coalesce("truth", F.lit(False))), "features")
    truth = rows.select("delivery_id", "truth")
    scored = {
        "robust z, raw": M.robust_z(rows, [], "quantity").withColumnRenamed("robust_z", "score"),
        "robust z, contextual": M.robust_z(rows, [], "deviation").withColumnRenamed("robust_z", "score"),
        "forest, raw": M.isolation_forest(rows, "delivery_id", RAW).withColumnRenamed("isolation", "score"),
        "forest, contextual": M.isolation_forest(rows, "delivery_id", CONTEXT).withColumnRenamed("isolation", "score"),
        "ecod, raw": M.ecod(rows, RAW).withColumnRenamed("ecod", "score"),
        "ecod, contextual": M.ecod(rows, CONTEXT).withColumnRenamed("ecod", "score"),
        "lof, raw": M.lof(rows, "delivery_id", "quantity").withColumnRenamed("lof", "score").join(truth, "delivery_id"),
        "lof, contextual": M.lof(rows, "delivery_id", "deviation").withColumnRenamed("lof", "score").join(truth, "delivery_id"),
    }
    long = union_all(*[df.select(F.lit(name).alias("detector"), "delivery_id", "score", "truth") for name, df in scored.items()])
    out = M.compare_detectors(materialize(long, "scores"), "detector", "score", "delivery_id", F.col("truth"))
    return out.select("detector", "k", "hits", F.round("average_precision", 6).alias("average_precision"), F.round("auc", 6).alias("auc"))
