"""Error injection: the dirty tables and their logs, with rows chosen by the key."""

from pyspark.sql import functions as F

from queries import query
from queries.predicates import events, lineitem, orders, part, table
from queries.retail import CTES, Retail
from truegrain.functions.scalars import make_gtin13
from truegrain.operators import inject as I
from truegrain.operators.diff import cell_diff

customer = table("customer")
K = lambda: F.col("o_orderkey")


def order_base(spark, d):
    return orders(spark, d).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.round("o_totalprice", 2).alias("o_totalprice"), F.col("o_orderdate").cast("date").alias("day"))


def run(spark, d, injectors, part_="dirty"):
    dirty, log = I.inject(order_base(spark, d), "orders", F.col("o_orderkey"), injectors, ["o_orderkey"])
    return dirty if part_ == "dirty" else log


PRICE = [
    I.Injector("o_totalprice", "wrong_unit", I.scaled("o_totalprice", 1000), rows=lambda: K() % 100 == 1),
    I.Injector("o_totalprice", "outlier", I.scaled("o_totalprice", 10), rows=lambda: K() % 100 == 2),
    I.Injector("o_totalprice", "outlier", I.fixed(80000.0), rows=lambda: K() == 77),
]


@query(
    "inj_01_scale_and_extreme",
    "SELECT o_orderkey, round(CASE WHEN o_orderkey % 100 = 1 THEN o_totalprice * 1000 WHEN o_orderkey % 100 = 2 THEN o_totalprice * 10 WHEN o_orderkey = 77 THEN 80000 ELSE o_totalprice END, 1) AS price FROM orders",
)
def inj_01(spark, d):
    return run(spark, d, PRICE).select("o_orderkey", F.round("o_totalprice", 1).alias("price"))


@query(
    "inj_01_error_log",
    "SELECT o_orderkey::VARCHAR AS row_id, CASE WHEN o_orderkey % 100 = 1 THEN 'wrong_unit' ELSE 'outlier' END AS error_type FROM orders WHERE o_orderkey % 100 IN (1, 2) OR o_orderkey = 77",
)
def inj_01_log(spark, d):
    return run(spark, d, PRICE, "log").select("row_id", "error_type")


@query(
    "inj_01_log_is_complete",
    "SELECT 'unlogged' AS kind, 0::BIGINT AS n FROM (SELECT count(*) FROM orders) UNION ALL SELECT 'logged', count(*) FROM orders WHERE o_orderkey % 100 IN (1, 2) OR o_orderkey = 77",
)
def inj_complete(spark, d):
    """Every changed cell of the dirty table is in the log."""
    clean = order_base(spark, d)
    dirty, log = I.inject(clean, "orders", F.col("o_orderkey"), PRICE, ["o_orderkey"])
    changed = cell_diff(clean, dirty, ["o_orderkey"], ["o_totalprice", "o_orderstatus", "o_custkey"])
    known = log.select(F.col("row_id").cast("bigint").alias("o_orderkey"), "column").withColumn("_l", F.lit(1))
    marked = changed.join(known, ["o_orderkey", "column"], "left")
    counts = marked.agg(F.count_if(F.col("_l").isNull()).alias("unlogged"), F.count("_l").alias("logged"))
    return counts.unpivot([], ["unlogged", "logged"], "kind", "n")


@query(
    "inj_02_spelling_variants",
    "SELECT o_orderkey % 20 = 3 AS chosen, count(*) AS n, count(*) FILTER (o_orderkey % 20 = 3 AND o_orderstatus IN ('F', 'O')) AS changed FROM orders GROUP BY 1",
)
def inj_02(spark, d):
    spell = {"F": ["f", "Fin", "done"], "O": ["o", "Open"]}
    dirty = run(spark, d, [I.Injector("o_orderstatus", "invalid_format", I.variant_of("o_orderstatus", spell, "o_orderkey"), rows=lambda: K() % 20 == 3)])
    return dirty.groupBy((K() % 20 == 3).alias("chosen")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus").isin("f", "Fin", "done", "o", "Open")).alias("changed")
    )


@query(
    "inj_03_typos",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 30 = 4 THEN substr(o_orderpriority, 1, 2) || substr(o_orderpriority, 4) WHEN o_orderkey % 30 = 5 THEN substr(o_orderpriority, 1, 1) || substr(o_orderpriority, 3, 1) || substr(o_orderpriority, 2, 1) || substr(o_orderpriority, 4) ELSE o_orderpriority END AS priority FROM orders""",
)
def inj_03(spark, d):
    dirty = run(spark, d, [
        I.Injector("o_orderpriority", "misspelling", I.drop_char("o_orderpriority"), rows=lambda: K() % 30 == 4),
        I.Injector("o_orderpriority", "misspelling", I.swap_chars("o_orderpriority"), rows=lambda: K() % 30 == 5),
    ])
    return dirty.select("o_orderkey", F.col("o_orderpriority").alias("priority"))


@query("inj_03_hash_chosen_typos")
def inj_03_hash(spark, d):
    dirty, log = I.inject(order_base(spark, d), "orders", K(), [
        I.Injector("o_orderpriority", "misspelling", I.typo("o_orderpriority", "o_orderkey"), share=0.01),
        I.Injector("o_totalprice", "outlier", I.scaled("o_totalprice", 10), share=0.01),
    ], ["o_orderkey"], seed=7)
    return log


@query(
    "inj_04_wrong_reference",
    """WITH ids AS (SELECT id, coalesce(lead(id) OVER (ORDER BY id), min(id) OVER ()) AS next_id FROM (SELECT DISTINCT c_custkey AS id FROM customer))
    SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 6 THEN coalesce(next_id, o_custkey) ELSE o_custkey END AS customer FROM orders LEFT JOIN ids ON o_custkey = id""",
)
def inj_04(spark, d):
    based = I.with_successor(order_base(spark, d), "o_custkey", customer(spark, d), "c_custkey")
    dirty, _ = I.inject(based, "orders", K(), [I.Injector("o_custkey", "wrong_reference", I.next_existing("o_custkey"), rows=lambda: K() % 50 == 6)], ["o_orderkey"])
    return dirty.select("o_orderkey", F.col("o_custkey").alias("customer"))


@query(
    "inj_05_violated_dependency",
    "SELECT c_custkey, CASE WHEN c_custkey % 40 = 7 THEN (c_nationkey + 5) % 25 ELSE c_nationkey END AS nation, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def inj_05(spark, d):
    joined = customer(spark, d).join(table("nation")(spark, d), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_nationkey", "n_name")
    dirty, _ = I.inject(joined, "customer", F.col("c_custkey"), [
        I.Injector("c_nationkey", "violated_dependency", lambda: (F.col("c_nationkey") + 5) % 25, rows=lambda: F.col("c_custkey") % 40 == 7)], ["c_custkey"])
    return dirty.select("c_custkey", F.col("c_nationkey").alias("nation"), "n_name")


@query("inj_06_misfielded", "SELECT p_partkey, CASE WHEN p_partkey % 40 = 8 THEN p_brand ELSE p_type END AS type FROM part")
def inj_06(spark, d):
    dirty, _ = I.inject(part(spark, d), "part", F.col("p_partkey"), [
        I.Injector("p_type", "misfielded_value", I.other_column("p_brand"), rows=lambda: F.col("p_partkey") % 40 == 8)], ["p_partkey"])
    return dirty.select("p_partkey", F.col("p_type").alias("type"))


@query(
    "inj_07_placeholder_and_sign",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 200 = 9 THEN DATE '1900-01-01' ELSE o_orderdate::DATE END AS day, round(CASE WHEN o_orderkey % 200 = 10 THEN -o_totalprice ELSE o_totalprice END, 2) AS price FROM orders",
)
def inj_07(spark, d):
    dirty = run(spark, d, [
        I.Injector("day", "placeholder", I.fixed("1900-01-01"), rows=lambda: K() % 200 == 9),
        I.Injector("o_totalprice", "illegal_value", I.scaled("o_totalprice", -1.0), rows=lambda: K() % 200 == 10),
    ])
    return dirty.select("o_orderkey", "day", F.round("o_totalprice", 2).alias("price"))


@query("inj_08_missing_records", "SELECT 'kept' AS part, count(*) AS n FROM orders WHERE o_orderkey % 300 <> 11 UNION ALL SELECT 'logged', count(*) FROM orders WHERE o_orderkey % 300 = 11")
def inj_08(spark, d):
    kept, log = I.drop_rows(order_base(spark, d), "orders", K(), K() % 300 == 11)
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
    return n(kept, "kept").unionByName(n(log, "logged"))


COPIED = """SELECT o_orderkey, round(o_totalprice, 2) AS price FROM orders UNION ALL
SELECT o_orderkey + 900000000, round(CASE WHEN o_orderkey % 3 = 0 THEN round(o_totalprice * 1.1, 1) ELSE o_totalprice END, 2) FROM orders WHERE o_orderkey % 200 = 12"""


@query("inj_09_duplicates", COPIED)
def inj_09(spark, d):
    dirty, _ = _copies(spark, d)
    return dirty.select("o_orderkey", F.round("o_totalprice", 2).alias("price"))


def _copies(spark, d):
    return I.copy_rows(
        order_base(spark, d), "orders", "o_orderkey", K() % 200 == 12, K() + 900000000,
        near=K() % 3 == 0, near_values={"o_totalprice": F.round(F.col("o_totalprice") * 1.1, 1)},
    )


@query(
    "inj_09_duplicate_log",
    "SELECT (o_orderkey + 900000000)::VARCHAR AS row_id, CASE WHEN o_orderkey % 3 = 0 THEN 'near_duplicate' ELSE 'duplicate_record' END AS error_type, 'copy of ' || o_orderkey AS dirty_value FROM orders WHERE o_orderkey % 200 = 12",
)
def inj_09_log(spark, d):
    return _copies(spark, d)[1].select("row_id", "error_type", "dirty_value")


@query(
    "inj_10_segments",
    CTES + """SELECT store_id, count(*) AS rows, count(*) FILTER (price = 2.49) AS stale FROM (
      SELECT date, store_id, CASE WHEN product_id % 40 = 11 AND store_id IN (2, 5) AND date >= DATE '1996-07-01' AND NOT promo THEN 2.49 ELSE unit_price END AS price FROM sales WHERE NOT (store_id = 4 AND date BETWEEN DATE '1997-09-20' AND DATE '1997-09-25')
      UNION ALL SELECT date, store_id, unit_price FROM sales WHERE store_id = 1 AND date = DATE '1996-11-21') GROUP BY 1""",
)
def inj_10(spark, d):
    """Stale prices for a segment, missing store-days, one day uploaded twice."""
    rows = Retail(spark, d)["sales"]
    day = F.col("date")
    stale = lambda: (F.col("product_id") % 40 == 11) & F.col("store_id").isin(2, 5) & (day >= F.lit("1996-07-01").cast("date")) & ~F.col("promo")
    row_id = F.concat_ws("|", F.col("date").cast("string"), "store_id", "product_id")
    priced, _ = I.inject(rows, "sales", row_id, [I.Injector("unit_price", "inconsistent_value", I.fixed(2.49), rows=stale)], ["date", "store_id", "product_id"])
    gap = (F.col("store_id") == 4) & day.between(F.lit("1997-09-20").cast("date"), F.lit("1997-09-25").cast("date"))
    kept, _ = I.drop_rows(priced, "sales", row_id, gap)
    twice, _ = I.double_upload(kept, "sales", row_id, (F.col("store_id") == 1) & (day == F.lit("1996-11-21").cast("date")))
    return twice.groupBy("store_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("unit_price") == 2.49).alias("stale"))


@query(
    "inj_11_transposed_digits",
    "SELECT l_quantity AS clean, CASE WHEN l_orderkey % 20 = 5 AND l_quantity BETWEEN 10 AND 99 THEN (l_quantity % 10) * 10 + floor(l_quantity / 10) ELSE l_quantity END AS dirty, count(*) AS n FROM lineitem GROUP BY 1, 2",
)
def inj_11(spark, d):
    rows = lineitem(spark, d).select("l_orderkey", F.col("l_quantity").alias("clean"), F.col("l_quantity").alias("dirty"))
    out, _ = I.inject(rows, "lineitem", F.col("l_orderkey"), [I.Injector("dirty", "transposed_digits", I.transposed("dirty"), rows=lambda: F.col("l_orderkey") % 20 == 5)], ["l_orderkey"])
    return out.groupBy("clean", "dirty").agg(F.count(F.lit(1)).alias("n"))


@query(
    "inj_12_point_edits",
    """SELECT p_partkey, CASE WHEN p_partkey % 90 = 1 THEN NULL ELSE p_name END AS name, CASE WHEN p_partkey % 90 = 2 THEN replace(p_retailprice::VARCHAR, '.', ',') ELSE p_retailprice::VARCHAR END AS price,
    CASE WHEN p_partkey % 90 = 3 THEN 283 ELSE p_partkey % 10 END AS supplier, CASE WHEN p_partkey % 90 = 4 THEN round(p_size / 2.54, 1) ELSE p_size END AS length FROM part""",
)
def inj_12(spark, d):
    k = lambda: F.col("p_partkey")
    base = part(spark, d).select("p_partkey", F.col("p_name").alias("name"), F.col("p_retailprice").cast("string").alias("price"), (k() % 10).alias("supplier"), F.col("p_size").cast("double").alias("length"))
    dirty, _ = I.inject(base, "part", k(), [
        I.Injector("name", "missing_value", I.fixed(None), rows=lambda: k() % 90 == 1),
        I.Injector("price", "invalid_format", I.decimal_comma("price"), rows=lambda: k() % 90 == 2),
        I.Injector("supplier", "dangling_reference", I.fixed(283), rows=lambda: k() % 90 == 3),
        I.Injector("length", "wrong_unit", I.as_inches("length"), rows=lambda: k() % 90 == 4),
    ], ["p_partkey"])
    return dirty


@query("inj_12_bad_check_digit", "SELECT count(*) FILTER (p_partkey % 90 = 5) AS broken, count(*) AS rows FROM part")
def inj_12_digit(spark, d):
    from truegrain.functions.scalars import gtin13_valid

    base = part(spark, d).select("p_partkey", make_gtin13(F.col("p_partkey") % 10, "p_partkey").alias("gtin"))
    dirty, _ = I.inject(base, "part", F.col("p_partkey"), [I.Injector("gtin", "invalid_format", I.bad_check_digit("gtin"), rows=lambda: F.col("p_partkey") % 90 == 5)], ["p_partkey"])
    return dirty.agg(F.count_if(~gtin13_valid("gtin")).alias("broken"), F.count(F.lit(1)).alias("rows"))


@query(
    "inj_13_disturbed_events",
    """WITH e AS (SELECT event_id, user_id % 20 = 7 AS skewed, event_id % 100 = 31 AS late, event_id % 200 = 9 AS again FROM events)
    SELECT event_id, (CASE WHEN skewed THEN -14400 ELSE 0 END + CASE WHEN late THEN 600 ELSE 5 END + r * 30)::BIGINT AS lag_seconds FROM e JOIN (VALUES (0), (1)) v(r) ON r = 0 OR again""",
)
def inj_13(spark, d):
    e = F.col("event_id")
    base = events(spark, d).select("event_id", "user_id", F.col("ts").alias("event_time"), (F.col("ts") + F.expr("INTERVAL 5 SECONDS")).alias("ingested_at"))
    out = I.disturb_events(base, "event_id", "event_time", "ingested_at", e % 100 == 31, F.lit(595), F.col("user_id") % 20 == 7, "4 HOURS", e % 200 == 9)
    lag = F.unix_micros(F.col("ingested_at").cast("timestamp")) - F.unix_micros(F.col("event_time").cast("timestamp"))
    return out.select("event_id", (lag / 1_000_000).cast("bigint").alias("lag_seconds"))


@query(
    "inj_14_checkout_errors",
    """SELECT CASE WHEN l_suppkey % 20 = 3 THEN 'bad scale' WHEN l_partkey % 50 = 4 THEN 'look-alike code' WHEN l_orderkey % 30 = 5 THEN 'missing tare' END AS error_cause, count(*) AS n,
    round(sum(CASE WHEN l_suppkey % 20 = 3 THEN l_quantity * 1.15 WHEN l_partkey % 50 = 4 THEN l_quantity WHEN l_orderkey % 30 = 5 THEN l_quantity + 0.02 ELSE l_quantity END), 3) AS recorded, round(sum(l_quantity), 3) AS truth FROM lineitem GROUP BY 1""",
)
def inj_14(spark, d):
    out = I.checkout_errors(lineitem(spark, d), "l_quantity", F.col("l_suppkey") % 20 == 3, F.col("l_partkey") % 50 == 4, F.col("l_orderkey") % 30 == 5)
    return out.groupBy("error_cause").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 3).alias("recorded"), F.round(F.sum("true_quantity"), 3).alias("truth"))


@query(
    "inj_15_drift",
    """SELECT event_id, round(CASE WHEN user_id % 8 = 2 AND day >= DATE '2024-01-10' THEN value * 1.8 ELSE value END, 6) AS demand,
    round(CASE WHEN user_id % 8 = 1 THEN value * (1 + 0.0015 * greatest(day - DATE '2024-01-05', 0)) ELSE value END, 6) AS creep,
    round(CASE WHEN user_id % 8 IN (6, 7) AND day >= DATE '2024-01-15' THEN value * 2.20462 ELSE value END, 6) AS pounds,
    round(CASE WHEN day >= DATE '2024-01-20' THEN value * 1.8 + 32 ELSE value END, 6) AS fahrenheit FROM (SELECT *, ts::DATE AS day FROM events)""",
)
def inj_15(spark, d):
    rows = events(spark, d).withColumn("day", F.col("ts").cast("date"))
    store = F.col("user_id") % 8
    return rows.select(
        "event_id",
        F.round(I.demand_shift("value", "day", "2024-01-10", 1.8, store == 2), 6).alias("demand"),
        F.round(I.sensor_creep("value", "day", "2024-01-05", 0.0015, store == 1), 6).alias("creep"),
        F.round(I.unit_switch("value", "day", "2024-01-15", 2.20462, 0.0, store.isin(6, 7)), 6).alias("pounds"),
        F.round(I.unit_switch("value", "day", "2024-01-20", 1.8, 32.0, F.lit(True)), 6).alias("fahrenheit"),
    )
