"""Cross-table checks."""

from pyspark.sql import functions as F

from queries import query
from queries.predicates import events, lineitem, orders, part, table
from queries.retail import CTES, Retail
from truegrain.functions.predicates import null_safe_ne
from truegrain.functions.scalars import pad_code
from truegrain.operators import joins as J
from truegrain.operators.aggregates import batch_vs_history
from truegrain.operators.match import agreeing_tuples, nearest
from truegrain.operators.repair import star

customer, nation, region, supplier = map(table, ["customer", "nation", "region", "supplier"])


@query(
    "jn_01_reference_lookup",
    CTES + """SELECT s.id, s.city, z.city AS reference_city, s.city = z.city AS same, s.city IS DISTINCT FROM z.city AS violation
    FROM stores s LEFT JOIN zip_codes z ON lpad(s.zip, 5, '0') = z.zip""",
)
def jn_01(spark, d):
    t = Retail(spark, d)
    z = t["zip_codes"].select(F.col("zip").alias("_zip"), F.col("city").alias("reference_city"))
    joined = J.lookup(t["stores"], z, pad_code("zip", 5) == F.col("_zip"))
    return joined.select(
        "id", "city", "reference_city",
        (F.col("city") == F.col("reference_city")).alias("same"),
        null_safe_ne("city", "reference_city").alias("violation"),
    )


@query(
    "jn_02_catalog_consistency",
    CTES + "SELECT s.date, s.store_id, s.product_id, s.unit_price, c.unit_price AS catalog_price FROM sales s JOIN catalog c ON s.product_id = c.id WHERE NOT s.promo AND abs(s.unit_price - c.unit_price) > 0.005",
)
def jn_02(spark, d):
    t = Retail(spark, d)
    c = t["catalog"].select(F.col("id").alias("_id"), F.col("unit_price").alias("catalog_price"))
    regular = t["sales"].filter(~F.col("promo"))
    off = J.catalog_consistency(regular, c, F.col("product_id") == F.col("_id"), "unit_price", "catalog_price")
    return off.select("date", "store_id", "product_id", "unit_price", "catalog_price")


@query(
    "jn_03_audit_tolerance",
    CTES + """SELECT store_id, count(*) AS audited, count(*) FILTER (abs(counted_qty - audited_qty) <= 0.05 * audited_qty + 0.5) AS close
    FROM stock_counts JOIN stock_audit USING (date, store_id, product_id) GROUP BY 1""",
)
def jn_03(spark, d):
    t = Retail(spark, d)
    joined = t["stock_counts"].join(t["stock_audit"], ["date", "store_id", "product_id"])
    close = J.within_tolerance("counted_qty", "audited_qty")
    return joined.groupBy("store_id").agg(F.count(F.lit(1)).alias("audited"), F.count_if(close).alias("close"))


@query(
    "jn_04_derived_key",
    """SELECT e.day, e.n AS events, o.n AS orders FROM (SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY 1) e
    JOIN (SELECT o_orderdate::DATE + INTERVAL 24 YEAR AS shifted, count(*) AS n FROM orders GROUP BY 1) o ON e.day = o.shifted::DATE""",
)
def jn_04(spark, d):
    per_day = orders(spark, d).groupBy(F.add_months(F.col("o_orderdate").cast("date"), 288).alias("shifted")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    e = events(spark, d).groupBy(F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("events"))
    return J.derived_key_join(e, per_day, F.col("day"), "shifted").select("day", "events", "orders")


@query(
    "jn_05_coverage",
    CTES + """SELECT round(avg((r.report_id IS NOT NULL)::INT), 9) AS score FROM truth t LEFT JOIN oos_reports r
    ON t.store_id = r.store_id AND t.date = r.reported_at::DATE WHERE t.lost > 0""",
)
def jn_05(spark, d):
    t = Retail(spark, d)
    lost = t["truth"].filter(F.col("lost") > 0).select(F.col("date").alias("_d"), "store_id")
    reports = t["oos_reports"].select(F.col("reported_at").cast("date").alias("_d"), "store_id")
    return J.coverage(lost, reports, ["_d", "store_id"]).select(F.round("score", 9).alias("score"))


@query(
    "jn_06_dangling",
    """SELECT c_custkey, fk FROM (SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS fk FROM customer)
    WHERE fk IS NOT NULL AND fk NOT IN (SELECT n_nationkey FROM nation)""",
)
def jn_06(spark, d):
    k = F.col("c_custkey")
    child = customer(spark, d).select(
        "c_custkey", F.when(k % 13 == 0, None).when(k % 11 == 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey")).alias("fk")
    )
    return J.dangling(child, nation(spark, d), "fk", "n_nationkey")


@query(
    "jn_06_dangling_null_counts",
    """SELECT count(*) AS n FROM (SELECT CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS fk FROM customer) c
    WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c.fk)""",
)
def jn_06_null(spark, d):
    k = F.col("c_custkey")
    child = customer(spark, d).select(
        F.when(k % 13 == 0, None).when(k % 11 == 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey")).alias("fk")
    )
    return J.dangling(child, nation(spark, d), "fk", "n_nationkey", null_fk_ok=False).agg(F.count(F.lit(1)).alias("n"))


@query(
    "jn_06_orders_without_lines",
    "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def jn_06_orders(spark, d):
    return J.dangling(orders(spark, d), lineitem(spark, d), "o_orderkey", "l_orderkey").select("o_orderkey")


@query(
    "jn_07_denial_constraint",
    """SELECT DISTINCT big.p_partkey FROM part small JOIN part big ON small.p_type = big.p_type AND small.p_size < big.p_size WHERE big.p_retailprice < small.p_retailprice""",
)
def jn_07(spark, d):
    return J.cheaper_although_bigger(part(spark, d), "p_type", "p_size", "p_retailprice").select("p_partkey")


@query(
    "jn_08_cross_source_invariant",
    """WITH sold AS (SELECT l_shipdate::DATE AS date, l_suppkey AS k, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2),
    stock AS (SELECT date, k, lag(q) OVER (PARTITION BY k ORDER BY date) AS before FROM sold),
    came AS (SELECT o_orderdate::DATE AS date, o_custkey % 100 AS k, sum(o_totalprice) / 10000 AS q FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2)
    SELECT s.date, s.k, round(s.q, 4) AS q FROM sold s JOIN stock USING (date, k) LEFT JOIN came c USING (date, k) WHERE s.q > before + coalesce(c.q, 0) + 1""",
)
def jn_08(spark, d):
    sold = lineitem(spark, d).groupBy(F.col("l_shipdate").cast("date").alias("date"), F.col("l_suppkey").alias("k")).agg(
        F.sum("l_quantity").alias("q")
    )
    came = orders(spark, d).filter(F.col("o_orderstatus") != "P").select(
        F.col("o_orderdate").cast("date").alias("date"), (F.col("o_custkey") % 100).alias("k"), (F.col("o_totalprice") / 10000).alias("c")
    )
    found = J.oversold(sold, sold.withColumnRenamed("q", "stock"), came, ["k"], "date", "q", "stock", "c")
    return found.select("date", "k", F.round("q", 4).alias("q"))


@query("jn_10_nearest_name")
def jn_10(spark, d):
    """Best catalog name of each distinct entered name, cutoff 80."""
    t = Retail(spark, d)
    entered = t["products"].select(F.col("name").alias("value"))
    names = t["catalog"].groupBy("name").agg(F.min("id").alias("id"))
    return nearest(entered, "value", names, "name", "id", cutoff=80.0).withColumn("similarity", F.round("similarity", 6))


@query(
    "jn_11_partial_agreement",
    """WITH t AS (SELECT p_brand, p_type, p_size::VARCHAR AS p_size, p_partkey % 5 AS g, p_partkey % 7 AS h, count(*) AS support FROM part GROUP BY 1, 2, 3, 4, 5),
    rare AS (SELECT * FROM t WHERE support < 2), freq AS (SELECT * FROM t WHERE support >= 2)
    SELECT count(*) AS pairs, sum((r.p_brand <> f.p_brand)::INT + (r.p_type <> f.p_type)::INT + (r.p_size <> f.p_size)::INT + (r.g <> f.g)::INT + (r.h <> f.h)::INT)::BIGINT AS differences
    FROM rare r JOIN freq f ON (r.p_brand <> f.p_brand)::INT + (r.p_type <> f.p_type)::INT + (r.p_size <> f.p_size)::INT + (r.g <> f.g)::INT + (r.h <> f.h)::INT <= 2""",
)
def jn_11(spark, d):
    cols = ["p_brand", "p_type", "p_size", "g", "h"]
    rows = part(spark, d).select(
        "p_brand", "p_type", F.col("p_size").cast("string").alias("p_size"),
        (F.col("p_partkey") % 5).cast("string").alias("g"), (F.col("p_partkey") % 7).cast("string").alias("h"),
    )
    counts = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("support"))
    pairs = agreeing_tuples(
        counts.filter("support < 2").drop("support"), counts.filter("support >= 2"), cols, max_differences=2
    )
    return pairs.agg(F.count(F.lit(1)).alias("pairs"), F.sum(F.size("differs")).alias("differences"))


@query(
    "jn_12_membership",
    "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01') AS active FROM customer",
)
def jn_12(spark, d):
    recent = orders(spark, d).filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    ids = recent.select(F.col("o_custkey").alias("c_custkey"))
    return J.flag_members(customer(spark, d).select("c_custkey"), ids, "c_custkey", "active")


@query(
    "jn_13_seasonal_windows",
    """WITH w AS (SELECT DATE '2000-01-03' + (i * 7)::INT AS week FROM range(0, 51) t(i)),
    o AS (SELECT o_orderdate::DATE AS day, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1)
    SELECT week, coalesce(sum(n) FILTER (day BETWEEN week AND week + 6), 0)::BIGINT AS current_orders,
           coalesce(sum(n) FILTER (day BETWEEN week - 378 AND week - 344), 0)::BIGINT AS reference_orders
    FROM w JOIN o ON day BETWEEN week AND week + 6 OR day BETWEEN week - 378 AND week - 344 GROUP BY 1""",
)
def jn_13(spark, d):
    rows = J.seasonal_windows(orders(spark, d).select("o_orderdate"), "o_orderdate", "2000-01-03", "2000-12-18")
    ref = F.col("is_reference")
    return rows.groupBy("week").agg(F.count_if(~ref).alias("current_orders"), F.count_if(ref).alias("reference_orders"))


@query(
    "jn_14_feature_join",
    CTES + """SELECT s.date, s.store_id, s.product_id, round(s.quantity, 2) AS quantity, w.temp_c, isodow(s.date) - 1 AS weekday, s.promo::INT AS promo
    FROM sales s LEFT JOIN weather w ON s.date = w.date AND 'S' || s.store_id = w.station""",
)
def jn_14(spark, d):
    t = Retail(spark, d)
    station = F.concat(F.lit("S"), F.col("store_id").cast("string"))
    joined = t["sales"].withColumn("station", station).join(t["weather"], ["date", "station"], "left")
    return joined.select(
        "date", "store_id", "product_id", F.round("quantity", 2).alias("quantity"), "temp_c",
        F.weekday("date").cast("bigint").alias("weekday"), F.col("promo").cast("int").alias("promo"),
    )


@query(
    "jn_15_star",
    """SELECT o_orderkey, c_name, n_name, r_name, o_orderdate::DATE - (c_custkey % 7)::INT AS order_date FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def jn_15(spark, d):
    wide = star(
        orders(spark, d),
        [
            (customer(spark, d), "o_custkey", "c_custkey"),
            (nation(spark, d), "c_nationkey", "n_nationkey"),
            (region(spark, d), "n_regionkey", "r_regionkey"),
        ],
    )
    lead = (F.col("c_custkey") % 7).cast("int")
    return wide.select("o_orderkey", "c_name", "n_name", "r_name", F.date_sub(F.col("o_orderdate").cast("date"), lead).alias("order_date"))


@query(
    "jn_16_batch_vs_last",
    """SELECT n.k, round(n.m / b.m, 8) AS ratio FROM (SELECT l_suppkey AS k, avg(l_quantity) AS m FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' GROUP BY 1) n
    JOIN (SELECT l_suppkey AS k, avg(l_quantity) AS m FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01' GROUP BY 1) b USING (k)""",
)
def jn_16(spark, d):
    rows = lineitem(spark, d).select(F.col("l_suppkey").alias("k"), "l_quantity", "l_shipdate")
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    r = batch_vs_history(rows.filter(F.col("l_shipdate") >= cut), rows.filter(F.col("l_shipdate") < cut), ["k"], "l_quantity")
    return r.select("k", F.round("ratio", 8).alias("ratio"))


UNIT_SPELLINGS = {"Kg": "kg", "KG": "kg", "lbs": "kg", "ct": "count", "Liter": "liter"}


@query(
    "jn_17_mapping",
    CTES + "SELECT delivery_id, unit, CASE unit WHEN 'Kg' THEN 'kg' WHEN 'KG' THEN 'kg' WHEN 'lbs' THEN 'kg' WHEN 'ct' THEN 'count' WHEN 'Liter' THEN 'liter' ELSE unit END AS canonical FROM deliveries",
)
def jn_17(spark, d):
    rows = Retail(spark, d)["deliveries"]
    return rows.select("delivery_id", "unit", J.map_values(rows, "unit", UNIT_SPELLINGS).alias("canonical"))


@query(
    "src_07_key_as_text_audit",
    CTES + """SELECT count(*) AS rows, count(*) FILTER (gtin_number IN (SELECT gtin FROM catalog)) AS matched_as_number,
    count(*) FILTER (lpad(gtin_number, 13, '0') IN (SELECT gtin FROM catalog)) AS matched_as_text
    FROM (SELECT try_cast(gtin AS BIGINT)::VARCHAR AS gtin_number FROM products)""",
)
def src_07(spark, d):
    t = Retail(spark, d)
    return J.key_as_text_audit(t["products"], t["catalog"], "gtin", 13)
