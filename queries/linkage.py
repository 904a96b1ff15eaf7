"""Near-duplicate records among the deliveries of the retail view."""

from pyspark.sql import functions as F

from queries import query
from queries.retail import CTES, Retail
from truegrain.operators import linkage as L
from truegrain.operators.ranks import join_back
from truegrain.session import materialize

SPEC = L.LinkSpec("delivery_id", ("store_id", "product_id"), "delivery_date", "quantity", "unit")

PROFILE_SQL = """, p AS (SELECT store_id, product_id, delivery_date AS day, quantity AS amount, unit AS exact, count(*) AS n, min(delivery_id) AS first_id
FROM deliveries GROUP BY 1, 2, 3, 4, 5),
pairs AS (SELECT l.first_id AS id_l, r.first_id AS id_r, l.n AS n_l, r.n AS n_r, abs(l.day - r.day) AS gap, l.amount AS a, r.amount AS b, l.exact = r.exact AS same_exact
FROM p l JOIN p r ON l.store_id = r.store_id AND l.product_id = r.product_id AND (l.day, l.first_id) < (r.day, r.first_id) AND r.day - l.day <= 3)
"""

NEAR = "(a <> b AND abs(a - b) / greatest(abs(a), abs(b)) < 0.15)"


@query(
    "jn_09_blocked_pairs",
    f"{CTES}{PROFILE_SQL} SELECT id_l, id_r, gap FROM pairs WHERE a = b OR {NEAR}",
)
def jn_09(spark, d):
    pairs = L.candidate_pairs(L.profiles(Retail(spark, d)["deliveries"], SPEC), SPEC)
    return pairs.select("id_l", "id_r", F.abs(F.datediff("day_l", "day_r")).cast("bigint").alias("gap"))


@query(
    "jn_09_blocked_pairs_all_amounts",
    f"{CTES}{PROFILE_SQL} SELECT id_l, id_r, gap, CASE WHEN gap = 0 THEN 0 WHEN gap <= 1 THEN 1 ELSE 2 END AS day_level, CASE WHEN a = b THEN 0 WHEN {NEAR} THEN 1 ELSE 2 END AS amount_level, same_exact FROM pairs",
)
def jn_09_all(spark, d):
    p = L.profiles(Retail(spark, d)["deliveries"], SPEC)
    pairs = L.gammas(L.candidate_pairs(p, SPEC, all_amounts=True), SPEC)
    return pairs.select("id_l", "id_r", F.abs(F.datediff("day_l", "day_r")).cast("bigint").alias("gap"), "day_level", "amount_level", "same_exact")


FIXED = dict(prior=1e-6, block_u=0.001, day_u=(0.001, 0.002, 0.004, 0.993), amount_u=(0.01, 0.1, 0.89), exact_u=0.4)


def _odds_sql():
    m = "CASE WHEN gap = 0 THEN 0.95 / 0.001 WHEN gap <= 1 THEN 0.04 / 0.002 ELSE 0.005 / 0.004 END"
    q = f"CASE WHEN a = b THEN 0.8 / 0.01 WHEN {NEAR} THEN 0.15 / 0.1 ELSE 0.05 / 0.89 END"
    e = "CASE WHEN same_exact THEN 0.9 / 0.4 ELSE 0.1 / 0.6 END"
    prior = "1e-6::DOUBLE / (1 - 1e-6::DOUBLE) * 0.999::DOUBLE / 0.001::DOUBLE"
    return f"(({prior}) * ({m})::DOUBLE * ({q})::DOUBLE * ({e})::DOUBLE)"


@query(
    "ml_07_fixed_parameter_scores",
    f"""{CTES}{PROFILE_SQL}, w AS (SELECT id_l, id_r, n_l, n_r, {_odds_sql()} AS w FROM pairs UNION ALL
    SELECT first_id, first_id, n, n, 1e-6::DOUBLE / (1 - 1e-6::DOUBLE) * 0.999::DOUBLE / 0.001::DOUBLE * (0.95::DOUBLE / 0.001) * (0.8::DOUBLE / 0.01) * (0.9::DOUBLE / 0.4) FROM p WHERE n > 1)
    SELECT id_l, id_r, n_l, n_r, round(w / (1 + w), 8) AS probability FROM w WHERE w / (1 + w) >= 0.01""",
)
def ml_07_fixed(spark, d):
    p = L.profiles(Retail(spark, d)["deliveries"], SPEC)
    scored = L.score_pairs(p, SPEC, L.LinkModel(**FIXED), 0.01)
    return scored.select("id_l", "id_r", "n_l", "n_r", F.round("probability", 8).alias("probability"))


THRESHOLDS = (0.01, 0.1, 0.3)
COPIED = "delivery_id % 211 = 10 AND delivery_id < 900000000"


@query(
    "ml_07_pair_quality",
    f"""{CTES}{PROFILE_SQL}, w AS (SELECT id_l, id_r, n_l, n_r, {_odds_sql()} AS w FROM pairs),
    s AS (SELECT least(id_l, id_r) AS id_l, greatest(id_l, id_r) AS id_r, n_l * n_r AS n, w / (1 + w) AS probability FROM w),
    m AS (SELECT delivery_id, min(delivery_id) OVER (PARTITION BY store_id, product_id, delivery_date, quantity, unit) AS pid FROM deliveries),
    known AS (SELECT least(a.pid, b.pid) AS id_l, greatest(a.pid, b.pid) AS id_r FROM m a JOIN m b ON b.delivery_id = a.delivery_id + 900000000 WHERE a.delivery_id % 211 = 10 AND a.delivery_id < 900000000),
    t AS (SELECT unnest([0.01, 0.1, 0.3])::DOUBLE AS threshold),
    r AS (SELECT threshold, (SELECT sum(n * (n - 1) / 2) FROM p) + coalesce((SELECT sum(n) FROM s WHERE probability >= threshold), 0) AS found,
      (SELECT count(*) FROM known k LEFT JOIN s USING (id_l, id_r) WHERE k.id_l = k.id_r OR s.probability >= threshold) AS hits, (SELECT count(*) FROM known) AS everything FROM t)
    SELECT threshold, found::BIGINT AS found, hits::BIGINT AS hits, round(hits / found, 9) AS precision, round(hits / everything, 9) AS recall FROM r""",
)
def ml_07_quality(spark, d):
    """Precision and recall of linked row pairs against the deliveries that were entered twice."""
    t = Retail(spark, d).stored("deliveries")
    rows = t["deliveries"]
    cols = ["store_id", "product_id", "delivery_date", "quantity", "unit"]
    members = join_back(rows, rows.groupBy(*cols).agg(F.min("delivery_id").alias("profile_id")), cols).select("profile_id", "delivery_id")
    truth = rows.filter(COPIED).select(F.col("delivery_id").alias("id_l"), (F.col("delivery_id") + 900000000).alias("id_r"))
    scored = materialize(L.score_pairs(L.profiles(rows, SPEC), SPEC, L.LinkModel(**FIXED), min(THRESHOLDS)), "scored")
    out = L.pair_quality(scored, truth, THRESHOLDS, members, "delivery_id")
    return out.select("threshold", "found", F.col("right").alias("hits"), F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


@query("ml_07_trained_linkage")
def ml_07(spark, d):
    """Trained model: linked profiles at p >= 0.01 with the number of row pairs behind them."""
    model, p = L.train(Retail(spark, d)["deliveries"], SPEC)
    return L.linked_row_pairs(L.score_pairs(p, SPEC, model, 0.01)).select(
        "id_l", "id_r", "day_level", "amount_level", "same_exact", "row_pairs", F.round("probability", 6).alias("probability")
    )


@query(
    "ml_08_exact_duplicates",
    CTES + """SELECT min(delivery_id) AS id_l, list_sort(list(delivery_id))[2] AS id_r, count(*) AS rows FROM deliveries GROUP BY store_id, product_id, delivery_date, quantity HAVING count(*) > 1""",
)
def ml_08(spark, d):
    return L.exact_duplicates(Retail(spark, d)["deliveries"], "delivery_id", ["store_id", "product_id", "delivery_date", "quantity"])
