"""Scalar functions over whole tables."""

from pyspark.sql import functions as F

from queries import query
from queries.predicates import documents, events, lineitem, orders, part
from queries.retail import CTES, Retail
from truegrain.functions import scalars as S
from truegrain.functions.similarity import indel_ratio, sorted_tokens, token_sort_ratio

DIGIT_SQL = "(10 - list_sum(list_transform(range(1, 13), lambda i: CAST(substr(body, i::INT, 1) AS INT) * CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END)) % 10) % 10"


@query(
    "fn_01_gtin13_valid",
    CTES + """SELECT category, count(*) AS n, count(*) FILTER (regexp_full_match(gtin, '[0-9]{13}')
    AND (10 - list_sum(list_transform(range(1, 13), lambda i: try_cast(substr(gtin, i::INT, 1) AS INT) * CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END)) % 10) % 10 = try_cast(substr(gtin, 13, 1) AS INT)) AS valid
    FROM products GROUP BY 1""",
)
def fn_01(spark, d):
    return Retail(spark, d)["products"].groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(S.gtin13_valid("gtin")).alias("valid")
    )


@query(
    "fn_02_make_gtin13",
    f"SELECT p_partkey, body || ({DIGIT_SQL})::INT::VARCHAR AS gtin FROM (SELECT p_partkey, '07' || lpad((p_partkey % 100)::VARCHAR, 4, '0') || lpad(p_partkey::VARCHAR, 6, '0') AS body FROM part)",
)
def fn_02(spark, d):
    return part(spark, d).select("p_partkey", S.make_gtin13(F.col("p_partkey") % 100, "p_partkey").alias("gtin"))


@query(
    "fn_03_pad_code",
    "SELECT c_custkey, CASE WHEN length(c_custkey::VARCHAR) >= 3 THEN c_custkey::VARCHAR ELSE lpad(c_custkey::VARCHAR, 3, '0') END AS code FROM customer",
)
def fn_03(spark, d):
    from truegrain.session import load

    return load(spark, d, "customer").select("c_custkey", S.pad_code("c_custkey", 3).alias("code"))


@query(
    "fn_04_indel_ratio",
    # an entered name is the true name less one character, so it is its own longest common subsequence
    CTES + """SELECT p.name AS entered, c.name AS name, count(*) AS n, round(200 * length(p.name) / (length(p.name) + length(c.name)), 6) AS score
    FROM products p JOIN catalog c ON p.id = c.id GROUP BY 1, 2""",
)
def fn_04(spark, d):
    """Similarity of each distinct product name and its entered form."""
    t = Retail(spark, d)
    pairs = t["products"].select("id", F.col("name").alias("entered")).join(t["catalog"].select("id", "name"), "id")
    distinct = pairs.groupBy("entered", "name").agg(F.count(F.lit(1)).alias("n"))
    return distinct.withColumn("score", F.round(indel_ratio("entered", "name"), 6))


@query(
    "fn_05_token_sort_ratio",
    "SELECT p_name, count(*) AS n, array_to_string(list_reverse(string_split(p_name, ' ')), ' ') AS turned, 100.0::DOUBLE AS score FROM part GROUP BY 1",
)
def fn_05(spark, d):
    """Similarity of each distinct name and the same words in another order."""
    names = part(spark, d).groupBy("p_name").agg(F.count(F.lit(1)).alias("n"))
    turned = F.array_join(F.reverse(F.split("p_name", " ")), " ")
    return names.withColumn("turned", turned).withColumn("score", F.round(token_sort_ratio("p_name", "turned"), 6))


@query(
    "fn_05_sorted_tokens",
    "SELECT p_name, array_to_string(list_sort(string_split(trim(p_name), ' ')), ' ') AS tokens, count(*) AS n FROM part GROUP BY 1, 2",
)
def fn_05_tokens(spark, d):
    return part(spark, d).groupBy("p_name").agg(F.count(F.lit(1)).alias("n")).withColumn("tokens", sorted_tokens("p_name"))


@query(
    "fn_06_calendar_features",
    """SELECT o_orderkey, isodow(o_orderdate) - 1 AS weekday, round(sin(2 * pi() * dayofyear(o_orderdate) / 365.25), 9) AS year_sin,
    round(cos(2 * pi() * dayofyear(o_orderdate) / 365.25), 9) AS year_cos, round(sin(2 * pi() * dayofyear(o_orderdate) / 365), 9) AS sin_365 FROM orders""",
)
def fn_06(spark, d):
    c = S.calendar_features("o_orderdate")
    return orders(spark, d).select(
        "o_orderkey",
        c["weekday"].cast("bigint").alias("weekday"),
        F.round(c["year_sin"], 9).alias("year_sin"),
        F.round(c["year_cos"], 9).alias("year_cos"),
        F.round(S.calendar_features("o_orderdate", 365)["year_sin"], 9).alias("sin_365"),
    )


@query(
    "fn_07_signed_log1p",
    "SELECT c_custkey, round(sign(c_acctbal) * ln(1 + abs(c_acctbal)), 8) AS v, round(exp(ln(1 + abs(c_acctbal))) - 1, 4) AS back FROM customer",
)
def fn_07(spark, d):
    from truegrain.session import load

    return load(spark, d, "customer").select(
        "c_custkey",
        F.round(S.signed_log1p("c_acctbal"), 8).alias("v"),
        F.round(F.expm1(F.log1p(F.abs("c_acctbal"))), 4).alias("back"),
    )


@query("fn_08_composite_key", CTES + "SELECT date || '|' || store_id || '|' || product_id AS row_id, round(quantity, 2) AS quantity FROM sales")
def fn_08(spark, d):
    return Retail(spark, d)["sales"].select(
        S.composite_key(S.day_text("date"), "store_id", "product_id").alias("row_id"), F.round("quantity", 2).alias("quantity")
    )


@query(
    "fn_09_convert_unit",
    """SELECT event_id, round(CASE WHEN user_id % 8 IN (6, 7) AND ts >= TIMESTAMP '2024-01-15' THEN value / 2.20462 ELSE value END, 6) AS kg,
    round(CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN (value - 32) * 5 / 9 ELSE value END, 6) AS celsius, round(CASE WHEN event_type = 'click' THEN value * 2.54 ELSE value END, 6) AS cm FROM events""",
)
def fn_09(spark, d):
    since = lambda day: F.col("ts") >= F.lit(day).cast("timestamp_ntz")
    return events(spark, d).select(
        "event_id",
        F.round(S.lb_to_kg("value", (F.col("user_id") % 8).isin(6, 7) & since("2024-01-15")), 6).alias("kg"),
        F.round(S.fahrenheit_to_celsius("value", since("2024-01-20")), 6).alias("celsius"),
        F.round(S.inch_to_cm("value", F.col("event_type") == "click"), 6).alias("cm"),
    )


@query(
    "fn_10_density_plausibility",
    """WITH d AS (SELECT p_partkey, (p_retailprice / 1000) * (1 + p_size % 12) / ((10 + p_size) * (5 + p_partkey % 20) * (4 + p_partkey % 15) / 1000) AS density FROM part)
    SELECT p_partkey, round(density, 6) AS density, CASE WHEN density > 3 * 0.5 AND density / (2.54 * 2.54 * 2.54) < 3 * 0.5 THEN 'inches'
    WHEN density <= 0.5 / 4 OR density >= 4 * 0.5 THEN 'swapped' ELSE 'ok' END AS verdict FROM d""",
)
def fn_10(spark, d):
    k, s = F.col("p_partkey"), F.col("p_size")
    density = S.case_density(10 + s, 5 + k % 20, 4 + k % 15, F.col("p_retailprice") / 1000, 1 + s % 12)
    return part(spark, d).select(
        "p_partkey", F.round(density, 6).alias("density"), S.density_plausibility(density, F.lit(0.5)).alias("verdict")
    )


@query(
    "fn_11_period_labels",
    "SELECT strftime(o_orderdate, '%Y-%m') AS month, date_trunc('month', o_orderdate)::DATE AS first_day, strftime(o_orderdate, '%m %b') AS label, count(*) AS n FROM orders GROUP BY 1, 2, 3",
)
def fn_11(spark, d):
    return orders(spark, d).groupBy(
        S.month_label("o_orderdate").alias("month"),
        S.month_start("o_orderdate").alias("first_day"),
        F.date_format("o_orderdate", "MM MMM").alias("label"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "fn_12_strip_prefix_int",
    "SELECT doc_id, try_cast(regexp_extract(tag, '^copy of (-?[0-9]+)$', 1) AS BIGINT) AS original FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'copy of x' ELSE 'copy of ' || (doc_id * 7) END AS tag FROM documents)",
)
def fn_12(spark, d):
    k = F.col("doc_id")
    tag = F.when(k % 3 == 0, "copy of x").otherwise(F.concat(F.lit("copy of "), (k * 7).cast("string")))
    return documents(spark, d).select("doc_id", S.strip_prefix_int(tag, "copy of ").alias("original"))


@query(
    "fn_13_time_rounding",
    """SELECT event_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minute,
    strftime(date_trunc('millisecond', ts + INTERVAL 5 HOUR), '%Y-%m-%d %H:%M:%S.%g') AS utc_ms FROM events""",
)
def fn_13(spark, d):
    stamp = "yyyy-MM-dd HH:mm:ss"
    return events(spark, d).select(
        "event_id",
        F.date_format(S.to_minute("ts"), stamp).alias("minute"),
        F.date_format(S.to_utc_millis(F.col("ts").cast("timestamp"), "America/New_York"), f"{stamp}.SSS").alias("utc_ms"),
    )


@query(
    "fn_14_log2_ratio",
    "SELECT l_returnflag, l_linestatus, round(log2(sum(l_extendedprice) / sum(l_extendedprice * (1 - l_discount))), 9) AS v FROM lineitem GROUP BY 1, 2",
)
def fn_14(spark, d):
    sums = lineitem(spark, d).groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_extendedprice").alias("a"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("b")
    )
    return sums.select("l_returnflag", "l_linestatus", F.round(S.log2_ratio("a", "b"), 9).alias("v"))


@query(
    "fn_15_nested_items",
    """WITH w AS (SELECT doc_id, string_split(text, ' ') AS words FROM documents)
    SELECT doc_id, len(words)::BIGINT AS items, len(list_filter(words, lambda x: length(x) > 8))::BIGINT AS long_items,
           len(list_filter(words, lambda x: x = '')) > 0 AS any_blank, list_max(list_transform(words, lambda x: length(x)))::BIGINT AS longest FROM w""",
)
def fn_15(spark, d):
    words = documents(spark, d).select("doc_id", F.split("text", " ").alias("words"))
    return words.select(
        "doc_id",
        F.size("words").cast("bigint").alias("items"),
        F.size(F.filter("words", lambda x: F.length(x) > 8)).cast("bigint").alias("long_items"),
        F.exists("words", lambda x: x == "").alias("any_blank"),
        F.array_max(F.transform("words", F.length)).cast("bigint").alias("longest"),
    )


@query(
    "fn_15_json_props",
    "SELECT json_extract_string(props, '$.k')::BIGINT AS k, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1",
)
def fn_15_json(spark, d):
    parsed = events(spark, d).withColumn("p", F.from_json("props", "k bigint"))
    return parsed.groupBy(F.col("p.k").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
