"""Sources, sinks and schema-on-read over the driver tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from queries import query
from queries.predicates import events, lineitem, orders, part
from queries.retail import CTES, Retail
from truegrain.functions import scalars as S
from truegrain.operators.documents import flatten_json, merged_shape, shape_census
from truegrain.operators.validate import validate_on_write
from truegrain.plans.contract import FieldRule, TableContract
from truegrain.session import scratch_path, tune
from truegrain.sources import evolution, nested, readers, sinks
from truegrain.sources.profile import type_profile


@query("src_01_read_table", "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def src_01(spark, d):
    schema = "o_orderkey bigint, o_orderstatus string, o_totalprice double"
    readers.read_table(tune(spark), f"{d}/orders.parquet", schema=schema, view="orders_view")
    return spark.sql("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders_view GROUP BY 1")


@query("src_02_table_registry", "SELECT p_type, count(*) AS n FROM part GROUP BY 1")
def src_02(spark, d):
    root, variant = d.rstrip("/").rsplit("/", 1)
    return readers.TableRegistry(tune(spark), root, variant).load("part").groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))


@query("src_03_read_all_text", CTES + "SELECT id, gtin, unit_price FROM products")
def src_03(spark, d):
    """Written as CSV and read back as text: codes keep their leading zero."""
    path = scratch_path(tune(spark), "text")
    rows = Retail(spark, d)["products"].select("id", "gtin", "unit_price")
    rows.write.option("header", "true").csv(path)
    return readers.read_all_text(spark, path, ["id", "gtin", "unit_price"]).withColumn("id", F.col("id").cast("bigint"))


@query(
    "src_04_type_profile",
    CTES + "".join(
        f"""{' UNION ALL ' if i else ''}SELECT '{c}' AS column_name, count(*) AS rows, count(*) FILTER ({c} IS NULL) AS nulls, count(*) FILTER (trim({c}::VARCHAR) = '') AS blanks,
        count(*) FILTER (try_cast({c}::VARCHAR AS DOUBLE) IS NOT NULL) AS double, '{t}' AS inferred FROM products"""
        for i, (c, t) in enumerate([("gtin", "string"), ("unit", "string"), ("unit_price", "string"), ("shelf_life_days", "bigint")])
    ),
)
def src_04(spark, d):
    out = type_profile(Retail(spark, d)["products"], ["gtin", "unit", "unit_price", "shelf_life_days"])
    return out.select("column_name", "rows", "nulls", "blanks", "double", "inferred")


@query("src_05_csv_with_rejects", "SELECT 'good' AS part, count(*) FILTER (p_partkey % 20 <> 3) AS n FROM part UNION ALL SELECT 'rejected', count(*) FILTER (p_partkey % 20 = 3) FROM part")
def src_05(spark, d):
    """Every part as a CSV line; some lines have one cell too many and must not be lost."""
    path = scratch_path(tune(spark), "lines")
    k = F.col("p_partkey")
    line = F.concat_ws(",", k.cast("string"), "p_brand", F.col("p_size").cast("string"))
    part(spark, d).select(F.when(k % 20 == 3, F.concat(line, F.lit(",extra"))).otherwise(line).alias("value")).write.text(path)
    good, rejected = readers.read_csv_with_rejects(spark, path, "p_partkey bigint, p_brand string, p_size int", header=False)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
    return count(good, "good").unionByName(count(rejected, "rejected"))


@query("src_06_normalize_nulls", CTES + "SELECT id, nullif(trim(unit_price), 'N/A') AS unit_price FROM products")
def src_06(spark, d):
    return readers.normalize_nulls(Retail(spark, d)["products"].select("id", "unit_price"))


@query(
    "src_08_parse_mixed_dates",
    """WITH t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%-m/%-d/%Y') WHEN 2 THEN strftime(o_orderdate, '%-d.%-m.%Y') ELSE 'soon' END AS txt, o_orderdate::DATE AS day FROM orders)
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE day END AS parsed, o_orderkey % 4 = 1 AND day(day) <= 12 AND day(day) <> month(day) AS ambiguous FROM t""",
)
def src_08(spark, d):
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    text = (
        F.when(k % 4 == 0, F.date_format(day, "yyyy-MM-dd")).when(k % 4 == 1, F.date_format(day, "M/d/yyyy"))
        .when(k % 4 == 2, F.date_format(day, "d.M.yyyy")).otherwise("soon")
    )
    rows = orders(spark, d).select("o_orderkey", text.alias("txt"))
    return rows.select("o_orderkey", S.parse_mixed_dates("txt").alias("parsed"), S.ambiguous_date("txt").alias("ambiguous"))


@query(
    "src_09_number_format",
    """WITH t AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN o_orderkey::VARCHAR WHEN 1 THEN o_orderkey || ',5' WHEN 2 THEN o_orderkey || 'O' WHEN 3 THEN 'N/A' WHEN 4 THEN o_orderkey || '.25' ELSE 'many' END AS txt FROM orders)
    SELECT o_orderkey % 6 AS kind, CASE o_orderkey % 6 WHEN 0 THEN 'number' WHEN 1 THEN 'decimal comma' WHEN 2 THEN 'letter for digit' WHEN 3 THEN 'missing' WHEN 4 THEN 'number' ELSE 'text' END AS format, count(*) AS n FROM t GROUP BY 1, 2""",
)
def src_09(spark, d):
    k = F.col("o_orderkey")
    s = k.cast("string")
    text = (
        F.when(k % 6 == 0, s).when(k % 6 == 1, F.concat(s, F.lit(",5"))).when(k % 6 == 2, F.concat(s, F.lit("O")))
        .when(k % 6 == 3, "N/A").when(k % 6 == 4, F.concat(s, F.lit(".25"))).otherwise("many")
    )
    return orders(spark, d).groupBy((k % 6).alias("kind"), S.number_format(text).alias("format")).agg(F.count(F.lit(1)).alias("n"))


NESTED = """'{"k": ' || json_extract_string(props, '$.k') || ', "pack": {"size": ' || (event_id % 7) || CASE WHEN event_id % 3 = 0 THEN '' ELSE ', "unit": "kg"' END || '}}'"""


def nested_props(spark, d):
    e = F.col("event_id")
    unit = F.when(e % 3 == 0, "").otherwise(', "unit": "kg"')
    return events(spark, d).select(
        "event_id",
        F.concat(F.lit('{"k": '), F.get_json_object("props", "$.k"), F.lit(', "pack": {"size": '), (e % 7).cast("string"), unit, F.lit("}}")).alias("doc"),
    )


@query(
    "src_10_flatten_json",
    f"""SELECT event_id, json_extract_string(doc, '$.k')::BIGINT AS k, json_extract_string(doc, '$.pack.size')::BIGINT AS "pack.size", json_extract_string(doc, '$.pack.unit') AS "pack.unit" FROM (SELECT event_id, {NESTED} AS doc FROM events)""",
)
def src_10(spark, d):
    return flatten_json(nested_props(spark, d), "doc", "k bigint, pack struct<size: bigint, unit: string>")


@query(
    "src_10_shape_census",
    "SELECT CASE WHEN event_id % 3 = 0 THEN 'OBJECT<k: BIGINT, pack: OBJECT<size: BIGINT>>' ELSE 'OBJECT<k: BIGINT, pack: OBJECT<size: BIGINT, unit: STRING>>' END AS shape, count(*) AS records FROM events GROUP BY 1",
)
def src_10_census(spark, d):
    return shape_census(nested_props(spark, d), "doc")


@query("src_10_merged_shape", "SELECT 'OBJECT<k: BIGINT, pack: OBJECT<size: BIGINT, unit: STRING>>' AS shape FROM (SELECT count(*) FROM events)")
def src_10_merged(spark, d):
    return merged_shape(nested_props(spark, d), "doc")


ORDER_CONTRACT = TableContract(
    "orders",
    (
        FieldRule("o_orderkey", "bigint", required=True),
        FieldRule("o_totalprice", "double", maximum=400000),
        FieldRule("o_orderstatus", "string", allowed=("F", "O")),
    ),
)


@query(
    "src_11_write_quarantine",
    "SELECT CASE WHEN o_totalprice > 400000 OR o_orderstatus = 'P' THEN 'bad' ELSE 'good' END AS part, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
)
def src_11(spark, d):
    """Split to two places, then read both back."""
    folder = scratch_path(tune(spark), "quarantine")
    rows = orders(spark, d).select("o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.write_quarantine(rows, ORDER_CONTRACT, f"{folder}/good", f"{folder}/bad")
    good = spark.read.parquet(f"{folder}/good").select("o_totalprice").withColumn("part", F.lit("good"))
    bad = spark.read.schema("o_orderkey bigint, o_totalprice double, o_orderstatus string, error string, reason string").option("header", "true").csv(f"{folder}/bad")
    both = good.unionByName(bad.select("o_totalprice").withColumn("part", F.lit("bad")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("src_12_write_jsonl", "SELECT o_orderkey, o_totalprice AS value FROM orders WHERE o_totalprice > 450000")
def src_12(spark, d):
    path = scratch_path(tune(spark), "alerts")
    sinks.write_jsonl(orders(spark, d).filter("o_totalprice > 450000").select("o_orderkey", F.col("o_totalprice").alias("value")), path)
    return readers.read_table(spark, path, "json", "o_orderkey bigint, value double")


@query("src_13_format_roundtrip")
def src_13(spark, d):
    return sinks.format_roundtrip_report(events(spark, d).withColumn("day", F.col("ts").cast("date"))).drop("write_seconds", "bytes")


EVENT_V1 = TableContract("event", (FieldRule("event_id", "bigint", required=True), FieldRule("event_type", "string"), FieldRule("value", "float"), FieldRule("props", "string")))
EVENT_V2 = TableContract("event", (FieldRule("event_id", "bigint", required=True), FieldRule("value", "double"), FieldRule("promo", "boolean", required=True, default=False), FieldRule("loyalty_id", "string")))


@query("src_14_read_as", "SELECT event_id, round(value::FLOAT::DOUBLE, 4) AS value, false AS promo, NULL::VARCHAR AS loyalty_id FROM events")
def src_14(spark, d):
    old = events(spark, d).select("event_id", "event_type", F.col("value").cast("float").alias("value"), "props")
    return evolution.read_as(old, EVENT_V1, EVENT_V2).withColumn("value", F.round("value", 4))


ITEM_V1 = T.StructType().add("part", "long").add("quantity", "integer").add("flag", "string", True, {"symbols": ["A", "N", "R"]})
ITEM_V2 = T.StructType().add("quantity", "long").add("product", "long", True, {"aliases": ["part"]}).add("unit", "string", False, {"default": "pc"}).add("flag", "string", True, {"symbols": ["A", "R"], "symbol_default": "open"})
ORDER_V1 = T.StructType().add("order", "long").add("lines", T.ArrayType(ITEM_V1))
ORDER_V2 = T.StructType().add("order", "long").add("items", T.ArrayType(ITEM_V2), True, {"aliases": ["lines"]})


@query(
    "src_14_read_nested",
    """SELECT l_orderkey AS "order", l_partkey AS product, l_quantity::INTEGER::BIGINT AS quantity, 'pc' AS unit,
    CASE WHEN l_returnflag IS NULL OR l_returnflag IN ('A', 'R') THEN l_returnflag ELSE 'open' END AS flag FROM lineitem""",
)
def src_14_nested(spark, d):
    """Order lines written as an array of structs, read with renamed, widened, added and remapped fields."""
    line = F.struct(F.col("l_partkey").alias("part"), F.round("l_quantity").cast("int").alias("quantity"), F.col("l_returnflag").alias("flag"))
    old = lineitem(spark, d).select(F.col("l_orderkey").alias("order"), F.array(line).alias("lines"))
    return nested.read_nested(old, ORDER_V1, ORDER_V2).select("order", F.inline("items"))


EVENT_V3 = TableContract("event", (FieldRule("event_id", "bigint", required=True), FieldRule("value", "string", required=True), FieldRule("register", required=True)))


@query("src_15_compatibility", "SELECT 'v2' AS version, 'backward' AS direction, count(*) AS rows FROM events UNION ALL SELECT 'v3', 'backward', 0 UNION ALL SELECT 'v3', 'forward', 0")
def src_15(spark, d):
    """Rows of the event table that each side can read from the other; 0 where it must refuse."""
    old = events(spark, d).select("event_id", "event_type", F.col("value").cast("float").alias("value"), "props")
    parts = []
    for version, direction, writer, reader in (("v2", "backward", EVENT_V1, EVENT_V2), ("v3", "backward", EVENT_V1, EVENT_V3), ("v3", "forward", EVENT_V3, EVENT_V1)):
        readable = not evolution.reading_problems(writer, reader)
        rows = evolution.read_as(old, writer, reader) if readable else old.filter(F.lit(False))
        parts.append(rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(version).alias("version"), F.lit(direction).alias("direction"), "rows"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("src_16_validate_on_write", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def src_16(spark, d):
    contract = TableContract("orders", (FieldRule("o_orderkey", "bigint", required=True, unique=True), FieldRule("o_orderpriority", required=True)), allow_extra=False)
    path = scratch_path(tune(spark), "checked")
    validate_on_write(orders(spark, d).select("o_orderkey", "o_orderpriority"), contract, path)
    return readers.read_table(spark, path, "parquet", "o_orderkey bigint, o_orderpriority string").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("src_17_rounded_export", "SELECT l_orderkey, l_linenumber, round(l_extendedprice, 1) AS l_extendedprice, round(l_discount, 1) AS l_discount FROM lineitem")
def src_17(spark, d):
    """Rounded CSV export, read back."""
    from queries.predicates import lineitem

    path = scratch_path(tune(spark), "export")
    rows = lineitem(spark, d).select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    sinks.export_rounded_csv(rows, path, 1)
    return readers.read_table(spark, path, "csv", rows.schema)


@query("src_18_preview_extract", "SELECT * FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1997-03-01' AND DATE '1997-03-31' AND o_orderstatus = 'F'")
def src_18(spark, d):
    return sinks.preview_extract(orders(spark, d), "1997-03-01", "1997-03-31", o_orderstatus="F")
