"""Predicates, each measured over a whole table."""

from pyspark.sql import functions as F

from queries import query
from queries.retail import CTES, Retail
from truegrain.functions import predicates as P
from truegrain.operators.aggregates import share
from truegrain.session import load, tune


def table(name):
    return lambda spark, d: load(tune(spark), d, name)


lineitem, orders, part, events, documents = map(table, ["lineitem", "orders", "part", "events", "documents"])


def good(df, predicate, null_is_bad=False):
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(predicate).alias("good"),
        F.round(share(predicate, null_is_bad), 9).alias("score"),
    )


def good_sql(source, predicate, null_is_bad=False):
    verdict = f"coalesce({predicate}, false)" if null_is_bad else f"({predicate})"
    return f"SELECT count(*) AS n, count(*) FILTER ({predicate}) AS good, round(avg({verdict}::INT), 9) AS score FROM {source}"


@query("prd_01_in_set", good_sql("lineitem", "l_returnflag IN ('A', 'R')"))
def prd_01(spark, d):
    return good(lineitem(spark, d), P.in_set("l_returnflag", ["A", "R"]))


@query("prd_02_parses_positive", CTES + good_sql("products", "coalesce(try_cast(unit_price AS DOUBLE) > 0, false)"))
def prd_02(spark, d):
    return good(Retail(spark, d)["products"], P.parses_positive("unit_price"))


@query("prd_03_present", CTES + good_sql("stores", "city IS NOT NULL AND zip IS NOT NULL"))
def prd_03(spark, d):
    return good(Retail(spark, d)["stores"], P.present("city", "zip"))


@query("prd_04_full_match", CTES + good_sql("suppliers", "regexp_full_match(contact_phone, '[0-9]{3}-555-[0-9]{4}')"))
def prd_04(spark, d):
    return good(Retail(spark, d)["suppliers"], P.full_match("contact_phone", "[0-9]{3}-555-[0-9]{4}"))


@query(
    "prd_05_in_range",
    """SELECT count(*) FILTER (l_quantity BETWEEN 10 AND 20) AS closed, count(*) FILTER (l_quantity > 10 AND l_quantity < 20) AS open_ends,
    count(*) FILTER (l_quantity >= 40) AS no_upper, count(*) FILTER (l_quantity < 5) AS no_lower FROM lineitem""",
)
def prd_05(spark, d):
    q = "l_quantity"
    return lineitem(spark, d).agg(
        F.count_if(P.in_range(q, 10, 20)).alias("closed"),
        F.count_if(P.in_range(q, 10, 20, False, False)).alias("open_ends"),
        F.count_if(P.in_range(q, 40)).alias("no_upper"),
        F.count_if(P.in_range(q, hi=5, include_hi=False)).alias("no_lower"),
    )


@query(
    "prd_06_before",
    """SELECT o_orderpriority, count(*) AS n, count(*) FILTER (o_orderdate <= l_shipdate) AS good,
    count(*) FILTER (o_orderdate < l_shipdate) AS strictly FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def prd_06(spark, d):
    joined = lineitem(spark, d).join(orders(spark, d), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(P.before("o_orderdate", "l_shipdate", or_equal=True)).alias("good"),
        F.count_if(P.before("o_orderdate", "l_shipdate")).alias("strictly"),
    )


@query(
    "prd_07_within_interval",
    CTES + """SELECT store_id, count(*) FILTER (entered_at - received_at <= INTERVAL 24 HOUR) AS in_a_day,
    count(*) FILTER (entered_at - received_at < INTERVAL 60 SECOND) AS in_a_minute FROM deliveries GROUP BY 1""",
)
def prd_07(spark, d):
    return Retail(spark, d)["deliveries"].groupBy("store_id").agg(
        F.count_if(P.within_interval("received_at", "entered_at", "24 HOURS")).alias("in_a_day"),
        F.count_if(P.within_interval("received_at", "entered_at", "60 SECONDS", strict=True)).alias("in_a_minute"),
    )


@query(
    "prd_08_conditional",
    """SELECT count(*) FILTER (NOT CASE l_linestatus WHEN 'O' THEN l_returnflag IN ('N') WHEN 'F' THEN l_returnflag IN ('A', 'R') ELSE l_returnflag IN ('N') END) AS broken,
    count(*) FILTER (NOT (l_quantity > 40) OR l_discount > 0) AS implied FROM lineitem""",
)
def prd_08(spark, d):
    fits = P.conditional_set("l_linestatus", "l_returnflag", {"O": ["N"], "F": ["A", "R"]}, ["N"])
    implied = P.implies(F.col("l_quantity") > 40, F.col("l_discount") > 0)
    return lineitem(spark, d).agg(F.count_if(~fits).alias("broken"), F.count_if(implied).alias("implied"))


@query("prd_09_null_safe_ne", CTES + "SELECT count(*) FILTER (city IS DISTINCT FROM 'NATION_3') AS differs, count(*) FILTER (city <> 'NATION_3') AS plain FROM stores")
def prd_09(spark, d):
    c = F.col("city")
    return Retail(spark, d)["stores"].agg(
        F.count_if(P.null_safe_ne(c, F.lit("NATION_3"))).alias("differs"), F.count_if(c != "NATION_3").alias("plain")
    )


@query("prd_10_placeholder", CTES + "SELECT shelf_life_days, count(*) AS n FROM products WHERE shelf_life_days IN (0, 999, 9999) GROUP BY 1")
def prd_10(spark, d):
    p = Retail(spark, d)["products"]
    return p.filter(P.placeholder("shelf_life_days", [0, 999, 9999])).groupBy("shelf_life_days").agg(F.count(F.lit(1)).alias("n"))


@query("prd_11_date_in_period", good_sql("orders", "o_orderdate::DATE BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"))
def prd_11(spark, d):
    return good(orders(spark, d), P.date_in_period("o_orderdate", "1996-01-01", "1998-12-31"))


@query(
    "prd_12_month_batch",
    "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01' GROUP BY 1",
)
def prd_12(spark, d):
    month = P.month_batch(orders(spark, d), "o_orderdate", "1997-03-01")
    return month.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("prd_13_length_between", good_sql("documents", "length(text) BETWEEN 100 AND 2000"))
def prd_13(spark, d):
    return good(documents(spark, d), P.length_between("text", 100, 2000))


@query("prd_14_similar_inputs", "SELECT count(*) AS n, round(avg(l_extendedprice), 6) AS mean FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 3")
def prd_14(spark, d):
    rows = P.similar_inputs(lineitem(spark, d), l_returnflag="R", l_linenumber=3)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("l_extendedprice"), 6).alias("mean"))


@query("prd_15_whole_number_if", CTES + good_sql("deliveries", "CASE WHEN unit = 'count' THEN quantity = floor(quantity) ELSE true END"))
def prd_15(spark, d):
    return good(Retail(spark, d)["deliveries"], P.whole_number_if("quantity", F.col("unit") == "count"))


@query(
    "prd_16_lossy_cast",
    good_sql("(SELECT o_totalprice::VARCHAR AS price FROM orders)", "coalesce(try_cast(price AS DOUBLE) <> round(try_cast(price AS DOUBLE)), false)"),
)
def prd_16(spark, d):
    return good(orders(spark, d).select(F.col("o_totalprice").cast("string").alias("price")), P.lossy_cast("price"))


@query("prd_17_type_is", "SELECT true AS quantity_is_double, false AS key_is_double, count(*) AS rows FROM lineitem")
def prd_17(spark, d):
    df = lineitem(spark, d)
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(P.type_is(df, "l_quantity", "double")).alias("quantity_is_double"),
        F.lit(P.type_is(df, "l_orderkey", "double")).alias("key_is_double"),
        "rows",
    )
