"""Top rows, samples and set operations."""

from pyspark.sql import functions as F

from queries import query
from queries.aggregates import customer
from queries.predicates import documents, events, lineitem, orders, part, table
from queries.retail import CTES, Retail
from truegrain.operators import diff
from truegrain.operators import sampling as S


@query("top_01_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_01(spark, d):
    return S.top_n(orders(spark, d).select("o_orderkey", "o_totalprice"), 25, F.col("o_totalprice"), "o_orderkey")


@query(
    "top_02_top_share",
    """SELECT event_id, s FROM (SELECT event_id, round(value) AS s FROM events) QUALIFY row_number() OVER (ORDER BY s DESC, event_id) <= floor(0.05 * (SELECT count(*) FROM events))""",
)
def top_02(spark, d):
    rows = events(spark, d).select("event_id", F.round("value").alias("s"))
    return S.top_share(rows, 0.05, "s", "event_id")


@query(
    "top_03_examples_per_group",
    "SELECT p_type, p_name, place FROM (SELECT p_type, p_name, row_number() OVER (PARTITION BY p_type ORDER BY p_name) AS place FROM (SELECT DISTINCT p_type, p_name FROM part)) WHERE place <= 3",
)
def top_03(spark, d):
    out = S.examples_per_group(part(spark, d), ["p_type"], "p_name")
    return out.withColumn("place", F.col("place").cast("bigint"))


@query("smp_01_sample_n", "SELECT c_custkey, c_name FROM customer ORDER BY md5('1|' || c_custkey), c_custkey LIMIT 100")
def smp_01(spark, d):
    return S.sample_n(customer(spark, d).select("c_custkey", "c_name"), 100, "c_custkey", seed=1)


@query("smp_01_sample_fraction")
def smp_01_fraction(spark, d):
    return S.sample_fraction(orders(spark, d), 0.02, "o_orderkey", seed=1).select("o_orderkey", "o_totalprice")


@query(
    "smp_02_nested_subsets",
    """WITH days AS (SELECT DISTINCT ts::DATE AS day FROM events), p AS (SELECT day, r AS repeat, row_number() OVER (PARTITION BY r ORDER BY md5(r || '|' || day), day) AS place FROM days CROSS JOIN range(0, 3) t(r))
    SELECT repeat, size, count(*) AS n, round(sum(value), 4) AS total FROM events JOIN p ON ts::DATE = p.day CROSS JOIN (VALUES (5), (10), (20)) s(size) WHERE place <= size GROUP BY 1, 2""",
)
def smp_02(spark, d):
    rows = events(spark, d).withColumn("day", F.col("ts").cast("date"))
    out = S.nested_subsets(rows, "day", [5, 10, 20])
    return out.groupBy(F.col("repeat").cast("bigint").alias("repeat"), "size").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(
    "set_01_union_all",
    CTES + "SELECT 'products' AS source, id FROM products WHERE unit = 'lbs' UNION ALL SELECT 'suppliers', id FROM suppliers WHERE contact_phone = '999-9999999'",
)
def set_01(spark, d):
    t = Retail(spark, d)
    a = t["products"].filter("unit = 'lbs'").select(F.lit("products").alias("source"), "id")
    b = t["suppliers"].filter("contact_phone = '999-9999999'").select(F.lit("suppliers").alias("source"), "id")
    return diff.union_all(a, b)


@query(
    "set_02_split_by_cause",
    """WITH found AS (SELECT c_custkey FROM customer WHERE c_acctbal < 2000), missing AS (SELECT c_custkey FROM customer WHERE c_nationkey = 3), other AS (SELECT o_custkey AS c_custkey FROM orders WHERE o_orderstatus = 'P')
    SELECT c_custkey, CASE WHEN c_custkey IN (SELECT c_custkey FROM missing) THEN 'missing' WHEN c_custkey IN (SELECT c_custkey FROM other) THEN 'wrong' ELSE 'rest' END AS cause FROM found""",
)
def set_02(spark, d):
    c = customer(spark, d)
    missing = c.filter("c_nationkey = 3")
    wrong = orders(spark, d).filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return diff.split_by_cause(c.filter("c_acctbal < 2000"), "c_custkey", [("missing", missing), ("wrong", wrong)], "rest")


@query("set_02_intersect_minus", "SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' EXCEPT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def set_02_ids(spark, d):
    c = customer(spark, d)
    recent = orders(spark, d).filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")).select(F.col("o_custkey").alias("c_custkey"))
    return c.select("c_custkey").intersect(recent).exceptAll(c.filter("c_mktsegment = 'BUILDING'").select("c_custkey"))


@query("set_03_distinct", "SELECT lang, source, count(*) AS texts FROM (SELECT DISTINCT lang, source, text FROM documents) GROUP BY 1, 2")
def set_03(spark, d):
    return documents(spark, d).dropDuplicates(["lang", "source", "text"]).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("texts"))


@query(
    "set_04_append_rows",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer UNION ALL SELECT s_suppkey + 5000000, s_name, NULL FROM supplier",
)
def set_04(spark, d):
    extra = table("supplier")(spark, d).select((F.col("s_suppkey") + 5000000).alias("c_custkey"), F.col("s_name").alias("c_name"))
    return diff.append_rows(customer(spark, d).select("c_custkey", "c_name", "c_mktsegment"), extra)


@query(
    "set_05_melt_and_spread",
    """SELECT l_returnflag, 'quantity' AS metric, round(sum(l_quantity), 2) AS value FROM lineitem GROUP BY 1 UNION ALL SELECT l_returnflag, 'price', round(sum(l_extendedprice), 2) FROM lineitem GROUP BY 1""",
)
def set_05(spark, d):
    wide = lineitem(spark, d).groupBy("l_returnflag").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum("l_extendedprice"), 2).alias("price"))
    return diff.melt(wide, ["l_returnflag"], ["quantity", "price"])


@query(
    "set_05_pivot",
    "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1",
)
def set_05_pivot(spark, d):
    counts = orders(spark, d).groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return diff.spread(counts, ["o_orderpriority"], "o_orderstatus", "n", ["F", "O", "P"]).na.fill(0)
