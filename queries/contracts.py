"""Contract validation over the retail view and the driver tables."""

from pyspark.sql import functions as F

from queries import query
from queries.predicates import events, lineitem, orders, table
from queries.retail import CTES, Retail
from truegrain.operators import documents as doc
from truegrain.operators import validate as V
from truegrain.plans import contract as C
from truegrain.session import tune

customer = table("customer")

PRODUCTS = C.from_dict(
    {
        "name": "products",
        "fields": {
            "id": {"type": "bigint", "required": True, "above": 100, "unique": True},
            "gtin": {"pattern": "[0-9]{13}", "unique": True},
            "name": {"min_length": 2, "max_length": 255},
            "category": {"required": True, "allowed": ["produce", "meat", "refill", "dairy", "pantry"]},
            "unit": {"allowed": ["count", "kg", "liter"]},
            "unit_price": {"type": "double", "required": True, "above": 0, "maximum": 1500},
            "supplier_id": {"type": "bigint"},
            "shelf_life_days": {"type": "bigint", "minimum": 1, "maximum": 1825},
        },
        "foreign_keys": [("supplier_id", "suppliers", "id")],
        "row_checks": [("produce unit", lambda: (F.col("category") != "produce") | F.col("unit").isin("count", "kg"))],
    }
)

FAILURES_SQL = """
SELECT id, 'gtin' AS "column", 'pattern' AS "check", gtin AS value FROM products WHERE NOT regexp_full_match(gtin, '[0-9]{13}')
UNION ALL SELECT id, 'category', 'required', NULL FROM products WHERE category IS NULL
UNION ALL SELECT id, 'unit', 'in set', unit FROM products WHERE unit NOT IN ('count', 'kg', 'liter')
UNION ALL SELECT id, 'unit_price', 'type double', unit_price FROM products WHERE try_cast(unit_price AS DOUBLE) IS NULL
UNION ALL SELECT id, 'unit_price', '> 0', unit_price FROM products WHERE try_cast(unit_price AS DOUBLE) <= 0
UNION ALL SELECT id, 'unit_price', '<= 1500', unit_price FROM products WHERE try_cast(unit_price AS DOUBLE) > 1500
UNION ALL SELECT id, 'shelf_life_days', '>= 1', shelf_life_days::VARCHAR FROM products WHERE shelf_life_days < 1
UNION ALL SELECT id, 'shelf_life_days', '<= 1825', shelf_life_days::VARCHAR FROM products WHERE shelf_life_days > 1825
UNION ALL SELECT id, '*', 'produce unit', NULL FROM products WHERE NOT (category <> 'produce' OR unit IN ('count', 'kg'))
UNION ALL SELECT id, 'gtin', 'unique', gtin FROM (SELECT id, gtin, count(*) OVER (PARTITION BY gtin) AS n FROM products) WHERE n > 1
UNION ALL SELECT id, 'supplier_id', 'exists in suppliers', supplier_id::VARCHAR FROM products WHERE supplier_id NOT IN (SELECT id FROM suppliers)
"""


@query("val_01_validate", CTES + FAILURES_SQL)
def val_01(spark, d):
    t = Retail(spark, d)
    return V.validate(t["products"], PRODUCTS, ["id"], {"suppliers": t["suppliers"]})


@query(
    "val_02_quarantine",
    f"{CTES}, f AS ({FAILURES_SQL}) SELECT 'bad' AS part, count(*) AS n, sum(id)::BIGINT AS ids FROM products WHERE id IN (SELECT id FROM f) UNION ALL SELECT 'good', count(*), sum(id)::BIGINT FROM products WHERE id NOT IN (SELECT id FROM f)",
)
def val_02(spark, d):
    t = Retail(spark, d)
    good, bad = V.quarantine(t["products"], PRODUCTS, {"suppliers": t["suppliers"]})
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids")).select(F.lit(name).alias("part"), "n", "ids")
    return count(bad, "bad").unionByName(count(good, "good"))


@query("val_02_quarantine_reasons")
def val_02_reasons(spark, d):
    t = Retail(spark, d)
    _, bad = V.quarantine(t["products"], PRODUCTS, {"suppliers": t["suppliers"]}, passes=2)
    return bad.select("id", "reason")


LOAD = C.from_dict(
    {
        "name": "orders",
        "fields": {
            "id": {"type": "bigint", "required": True, "unique": True},
            "customer": {"type": "bigint", "required": True},
            "price": {"type": "double", "required": True, "minimum": 1000},
            "status": {"allowed": ["F", "O"]},
        },
        "foreign_keys": [("customer", "customer", "c_custkey")],
    }
)

BATCH_SQL = """batch AS (SELECT o_orderkey AS line, CASE WHEN o_orderkey % 10 = 4 THEN o_orderkey - 1 WHEN o_orderkey % 90 = 7 THEN o_orderkey + 10000000 ELSE o_orderkey + 20000000 END AS id,
CASE WHEN o_orderkey % 12 = 5 THEN NULL WHEN o_orderkey % 14 = 6 THEN o_custkey + 99999999 ELSE o_custkey END AS customer,
CASE WHEN o_orderkey % 16 = 8 THEN 'soon' ELSE o_totalprice::VARCHAR END AS price, o_orderstatus AS status FROM orders),
existing AS (SELECT o_orderkey AS id FROM orders)"""


def load_batch(spark, d):
    k = F.col("o_orderkey")
    return orders(spark, d).select(
        k.alias("line"),
        F.when(k % 10 == 4, k - 1).when(k % 90 == 7, k + 10000000).otherwise(k + 20000000).alias("id"),
        F.when(k % 12 == 5, None).when(k % 14 == 6, F.col("o_custkey") + 99999999).otherwise(F.col("o_custkey")).alias("customer"),
        F.when(k % 16 == 8, "soon").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.col("o_orderstatus").alias("status"),
    )


@query(
    "val_04_ddl_load",
    f"""WITH {BATCH_SQL}, first AS (SELECT b.*, try_cast(price AS DOUBLE) AS p, CASE WHEN try_cast(price AS DOUBLE) IS NULL THEN 'price type double' WHEN customer IS NULL THEN 'customer required'
      WHEN try_cast(price AS DOUBLE) < 1000 THEN 'price >= 1000' WHEN status NOT IN ('F', 'O') THEN 'status in set' WHEN customer NOT IN (SELECT c_custkey FROM customer) THEN 'customer exists in customer' END AS reason FROM batch b),
    keyed AS (SELECT *, CASE WHEN reason IS NULL AND id IN (SELECT id FROM existing) THEN 'id duplicate key' ELSE reason END AS r2 FROM first),
    placed AS (SELECT *, row_number() OVER (PARTITION BY id, r2 IS NULL ORDER BY line) AS place FROM keyed)
    SELECT line, CASE WHEN r2 IS NULL AND place > 1 THEN 'id duplicate key' ELSE r2 END AS reason,
           CASE WHEN r2 = 'price type double' THEN 'conversion' WHEN r2 IS NOT NULL OR place > 1 THEN 'constraint' END AS error FROM placed""",
)
def val_04(spark, d):
    existing = orders(spark, d).select(F.col("o_orderkey").alias("id"))
    out = V.ddl_load(load_batch(spark, d), existing, LOAD, ["line"], {"customer": customer(spark, d)})
    return out.select("line", "reason", "error")


@query("val_05_atomic_gate", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT 'refused', count(*) FROM (SELECT 1 FROM orders WHERE o_orderstatus = 'P' LIMIT 1)")
def val_05(spark, d):
    """One contract lets the whole batch pass, a stricter one refuses it for a single row."""
    loose = C.TableContract("orders", (C.FieldRule("o_totalprice", "double", required=True),))
    strict = C.TableContract("orders", (C.FieldRule("o_orderstatus", allowed=("F", "O")),))
    passed = V.atomic_gate(orders(spark, d), loose).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    try:
        V.atomic_gate(orders(spark, d), strict)
        refused = 0
    except V.BatchRefused:
        refused = 1
    return passed.unionByName(spark.createDataFrame([("refused", refused)], "o_orderstatus string, n bigint"))


@query(
    "val_06_accept_or_quarantine",
    f"""WITH {BATCH_SQL} SELECT coalesce(try_cast(price AS DOUBLE) >= 1000, false) AND customer IS NOT NULL AND customer IN (SELECT c_custkey FROM customer) AND status IN ('F', 'O') AND copies = 1 AS fine,
      count(*) AS n, sum(line)::BIGINT AS lines FROM (SELECT *, count(*) OVER (PARTITION BY id) AS copies FROM batch) GROUP BY 1""",
)
def val_06(spark, d):
    good, bad = V.quarantine(load_batch(spark, d), LOAD, {"customer": customer(spark, d)})
    count = lambda df, fine: df.agg(F.lit(fine).alias("fine"), F.count(F.lit(1)).alias("n"), F.sum("line").alias("lines"))
    return count(good, True).unionByName(count(bad, False))


@query(
    "val_07_dates_and_references",
    """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 1 THEN '2025-13-02' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS delivered, o_orderdate::DATE + CASE WHEN o_orderkey % 7 = 2 THEN -5 ELSE 7 END AS best_before,
      CASE WHEN o_orderkey % 11 = 3 THEN -1 ELSE o_custkey END AS customer FROM orders)
    SELECT CASE WHEN try_cast(delivered AS DATE) IS NULL THEN 'delivered type date' WHEN best_before <= try_cast(delivered AS DATE) THEN '* best before delivery' WHEN customer NOT IN (SELECT c_custkey FROM customer) THEN 'customer exists in customer' ELSE 'ok' END AS reason, count(*) AS n FROM t GROUP BY 1""",
)
def val_07(spark, d):
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    rows = orders(spark, d).select(
        "o_orderkey",
        F.when(k % 9 == 1, "2025-13-02").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("delivered"),
        F.date_add(day, F.when(k % 7 == 2, -5).otherwise(7)).alias("best_before"),
        F.when(k % 11 == 3, -1).otherwise(F.col("o_custkey")).alias("customer"),
    )
    contract = C.TableContract(
        "deliveries",
        (C.FieldRule("delivered", "date"),),
        foreign_keys=(C.ForeignKey("customer", "customer", "c_custkey"),),
        row_checks=(("best before delivery", lambda: F.col("best_before") > F.col("delivered").try_cast("date")),),
    )
    first = V.first_reason()
    flagged = V.flag_rows(rows, contract, {"customer": customer(spark, d)}).withColumn(
        "reason", F.when(F.size("failures") > 0, F.concat_ws(" ", first["column"], first["check"])).otherwise("ok")
    )
    return flagged.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


PACKAGE = """
resources:
  - name: customers
    path: customer.csv
    schema:
      fields:
        - {name: c_custkey, type: integer, constraints: {required: true, minimum: 1}}
        - {name: c_name, type: string, constraints: {required: true, minLength: 1, maxLength: 18}}
        - {name: c_mktsegment, type: string, constraints: {enum: [BUILDING, MACHINERY, HOUSEHOLD]}}
        - {name: c_nationkey, type: integer, constraints: {required: true}}
      primaryKey: [c_custkey]
      foreignKeys:
        - fields: [c_nationkey]
          reference: {resource: nations, fields: [n_nationkey]}
"""


@query(
    "val_08_package_validation",
    """SELECT c_custkey, 'c_custkey' AS "column", '>= 1' AS "check" FROM customer WHERE c_custkey < 1 UNION ALL SELECT c_custkey, 'c_name', 'length <= 18' FROM customer WHERE length(c_name) > 18
    UNION ALL SELECT c_custkey, 'c_mktsegment', 'in set' FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
    UNION ALL SELECT c_custkey, 'c_acctbal', 'unexpected column' FROM customer WHERE c_acctbal IS NOT NULL
    UNION ALL SELECT c_custkey, 'c_nationkey', 'exists in nations' FROM customer WHERE c_custkey % 31 = 2""",
)
def val_08(spark, d):
    contract = C.from_package_yaml(PACKAGE)["customers"]
    k = F.col("c_custkey")
    rows = customer(spark, d).withColumn("c_nationkey", F.when(k % 31 == 2, 777).otherwise(F.col("c_nationkey")))
    out = V.validate(rows, contract, ["c_custkey"], {"nations": table("nation")(spark, d)})
    return out.select("c_custkey", "column", "check")


PROPS_SCHEMA = {
    "type": "object",
    "required": ["k", "unit"],
    "additionalProperties": False,
    "properties": {"k": {"type": "integer", "minimum": 20}, "unit": {"enum": ["kg", "count"]}},
}


@query(
    "val_09_json_records",
    """WITH t AS (SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events)
    SELECT event_id, 'k' AS path, 'type integer' AS "check" FROM t WHERE event_id % 5 = 1 UNION ALL SELECT event_id, 'k', 'minimum' FROM t WHERE event_id % 5 <> 1 AND k < 20
    UNION ALL SELECT event_id, 'unit', 'required' FROM t WHERE event_id % 7 = 2 UNION ALL SELECT event_id, 'unit', 'enum' FROM t WHERE event_id % 7 = 3 UNION ALL SELECT event_id, 'note', 'unexpected' FROM t WHERE event_id % 11 = 4""",
)
def val_09(spark, d):
    e, k = F.col("event_id"), F.get_json_object("props", "$.k")
    text = F.concat(
        F.lit('{"k": '), F.when(e % 5 == 1, F.concat(F.lit('"'), k, F.lit('"'))).otherwise(k),
        F.when(e % 7 == 2, "").when(e % 7 == 3, ', "unit": "lbs"').otherwise(', "unit": "kg"'),
        F.when(e % 11 == 4, ', "note": 1').otherwise(""), F.lit("}"),
    )
    return doc.validate_records(events(spark, d).select("event_id", text.alias("doc")), "doc", PROPS_SCHEMA, ["event_id"])


NOTICE_SQL = """SELECT o_orderkey, o_orderkey % 6 = 1 AS bad_unit, o_orderkey % 8 = 3 AS cut, o_orderkey % 10 = 5 AS half FROM orders"""


def notices(spark, d, first=True):
    """One notice per order; the retry answers repair the unit and the cut-off, not the half item."""
    k = F.col("o_orderkey")
    unit = F.when((k % 6 == 1) & F.lit(first), "lbs").otherwise("kg")
    half = F.when(k % 10 == 5, "0.5").otherwise("4")
    text = F.concat(
        F.lit('{"supplier": "S'), (k % 50).cast("string"), F.lit('", "store_city": "Erie", "delivery_date": "'),
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('", "items": [{"product": "red ring", "quantity": 2.5, "unit": "'), unit,
        F.lit('"}, {"product": "small ring", "quantity": '), half, F.lit(', "unit": "count"}]'),
        F.when((k % 8 == 3) & F.lit(first), "").otherwise("}"),
    )
    return orders(spark, d).select("o_orderkey", text.alias("answer"))


@query(
    "val_10_nested_documents",
    f"""WITH t AS ({NOTICE_SQL}) SELECT o_orderkey, '' AS path, 'not JSON' AS "check" FROM t WHERE cut
    UNION ALL SELECT o_orderkey, 'items.0.unit', 'not a unit' FROM t WHERE bad_unit AND NOT cut UNION ALL SELECT o_orderkey, 'items.1.quantity', 'whole number for count' FROM t WHERE half AND NOT cut""",
)
def val_10(spark, d):
    tune(spark)
    parsed = notices(spark, d).select("o_orderkey", F.try_parse_json("answer").alias("_doc"))
    rows = parsed.select("o_orderkey", F.explode(doc.notice_errors("_doc")).alias("e"))
    return rows.select("o_orderkey", "e.path", "e.check")


@query(
    "val_11_validate_with_retry",
    f"""WITH t AS ({NOTICE_SQL}) SELECT CASE WHEN half THEN 'quarantined' WHEN cut OR bad_unit THEN 'ok after retry' ELSE 'ok' END AS status, count(*) AS n, count(*) FILTER (half) AS with_problems FROM t GROUP BY 1""",
)
def val_11(spark, d):
    tune(spark)
    out = doc.validate_with_retry(notices(spark, d), notices(spark, d, first=False), "o_orderkey")
    return out.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.count("problems").alias("with_problems"))


@query(
    "val_11_unknown_items",
    f"""WITH t AS ({NOTICE_SQL}) SELECT CASE WHEN half OR NOT EXISTS (SELECT 1 FROM part WHERE p_name = 'red ring') OR NOT EXISTS (SELECT 1 FROM part WHERE p_name = 'small ring') THEN 'quarantined'
    WHEN cut OR bad_unit THEN 'ok after retry' ELSE 'ok' END AS status, count(*) AS n FROM t GROUP BY 1""",
)
def val_11_items(spark, d):
    """Accepted notices whose items no catalog name resembles are quarantined as well."""
    tune(spark)
    judged = doc.validate_with_retry(notices(spark, d), notices(spark, d, first=False), "o_orderkey")
    names = table("part")(spark, d).groupBy("p_name").agg(F.min("p_partkey").alias("id"))
    out = doc.quarantine_unknown_items(judged, "o_orderkey", names, "p_name", "id")
    return out.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def entered(spark, d):
    k = F.col("id")
    return Retail(spark, d)["catalog"].select(
        k.alias("entry_id"), "name",
        F.when(k % 9 == 1, F.substring("gtin", 1, 12)).when(k % 9 == 2, F.concat(F.substring("gtin", 1, 12), ((F.substring("gtin", 13, 1).cast("int") + 1) % 10).cast("string")))
        .otherwise(F.col("gtin")).alias("gtin"),
        "category", F.when(k % 8 == 3, "liter").otherwise(F.col("unit")).alias("unit"), F.lit(3.5).alias("unit_price"), "supplier_id",
        F.lit(18).alias("case_pack"), F.when(k % 7 == 4, 20.0).otherwise(50.0).alias("case_length_cm"), F.lit(33.5).alias("case_width_cm"),
        F.when(k % 7 == 5, 2.0).otherwise(27.0).alias("case_height_cm"), F.lit(1.0).alias("unit_weight_kg"), F.lit(7).alias("shelf_life_days"),
    )


DENSITIES = {"produce": 0.4, "meat": 0.4, "refill": 0.4, "dairy": 0.4, "pantry": 0.4}


@query(
    "val_12_findings",
    CTES + """, e AS (SELECT id AS entry_id, category, CASE WHEN id % 8 = 3 THEN 'liter' ELSE unit END AS unit, id % 9 AS g, 18 * 1.0 / ((CASE WHEN id % 7 = 4 THEN 20.0 ELSE 50.0 END) * 33.5 * (CASE WHEN id % 7 = 5 THEN 2.0 ELSE 27.0 END) / 1000) AS density FROM catalog),
    f AS (SELECT entry_id, 'error' AS level, 'gtin' AS field FROM e WHERE g IN (1, 2) UNION ALL SELECT entry_id, 'error', 'gtin' FROM e WHERE g NOT IN (1, 2)
    UNION ALL SELECT entry_id, 'error', 'unit' FROM e WHERE g <> 1 AND NOT CASE category WHEN 'produce' THEN unit IN ('count', 'kg') WHEN 'meat' THEN unit IN ('count', 'kg') WHEN 'refill' THEN unit = 'liter' ELSE unit = 'count' END
    UNION ALL SELECT entry_id, 'warning', 'case dimensions' FROM e WHERE g <> 1 AND ((density > 1.2 AND density / (2.54 * 2.54 * 2.54) < 1.2) OR density <= 0.1 OR density >= 1.6))
    SELECT entry_id, level, field, count(*) AS n FROM f GROUP BY 1, 2, 3""",
)
def val_12(spark, d):
    t = Retail(spark, d)
    out = doc.findings(entered(spark, d), t["catalog"], DENSITIES, "entry_id", names=False)
    rows = out.select("entry_id", F.explode("findings").alias("f"))
    return rows.groupBy("entry_id", "f.level", "f.field").agg(F.count(F.lit(1)).alias("n"))


@query("val_12_findings_with_names")
def val_12_names(spark, d):
    t = Retail(spark, d)
    out = doc.findings(entered(spark, d), t["catalog"], DENSITIES, "entry_id")
    return out.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("findings")).alias("findings"))


@query("val_13_requires", "SELECT l_returnflag, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1")
def val_13(spark, d):
    contract = C.TableContract("lineitem", (C.FieldRule("l_quantity", "double", required=True, above=0), C.FieldRule("l_returnflag", allowed=("A", "N", "R"))))

    @V.requires(contract)
    def totals(df):
        return df.groupBy("l_returnflag").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"))

    return totals(lineitem(spark, d))


@query(
    "val_14_learned_contract",
    """WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events WHERE ts < TIMESTAMP '2024-01-08') SELECT event_id, 'value' AS "column", CASE WHEN value < lo THEN 'low' ELSE 'high' END AS side FROM events, b
    WHERE ts >= TIMESTAMP '2024-01-08' AND (value < lo OR value > hi)""",
)
def val_14(spark, d):
    cut = F.lit("2024-01-08").cast("timestamp_ntz")
    rows = events(spark, d).select("event_id", "ts", "value", "event_type")
    learned = C.learn(rows.filter(F.col("ts") < cut).select("value", "event_type"))
    out = V.validate(rows.filter(F.col("ts") >= cut), learned, ["event_id"])
    side = F.when(F.col("check").startswith(">="), "low").otherwise("high")
    return out.select("event_id", "column", side.alias("side"))


@query(
    "val_15_interface_contract",
    CTES + """SELECT 'quantity' AS "column", '<= 40.0' AS "check", count(*) AS n FROM sales WHERE quantity > 40 UNION ALL SELECT 'unit_price', '> 8', count(*) FROM sales WHERE unit_price <= 8
    UNION ALL SELECT 'date,store_id', 'unique', count(*) FROM (SELECT 1 FROM sales QUALIFY count(*) OVER (PARTITION BY date, store_id) > 1)""",
)
def val_15(spark, d):
    contract = C.TableContract(
        "daily sales",
        (C.FieldRule("quantity", "double", required=True, minimum=0, maximum=40.0), C.FieldRule("unit_price", "double", above=8), C.FieldRule("store_id", "bigint", minimum=1)),
        unique_keys=(("date", "store_id"),),
    )
    out = V.validate(Retail(spark, d)["sales"], contract, ["product_id"])
    return out.groupBy("column", "check").agg(F.count(F.lit(1)).alias("n"))


THRESHOLDS = [
    {"metric": "mean", "min": 9.0, "max": 11.0, "owner": "data"},
    {"metric": "errors", "max": 60.0, "owner": "platform"},
]
DAILY_METRICS_SQL = "m AS (SELECT ts::DATE AS day, 'mean' AS metric, round(avg(value), 6) AS value FROM events GROUP BY 1 UNION ALL SELECT ts::DATE, 'errors', count(*) FILTER (event_type = 'error')::DOUBLE FROM events GROUP BY 1)"


def daily_metrics(spark, d):
    wide = events(spark, d).groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.round(F.avg("value"), 6).alias("mean"), F.count_if(F.col("event_type") == "error").cast("double").alias("errors")
    )
    return wide.unpivot(["day"], ["mean", "errors"], "metric", "value")


@query(
    "val_16_threshold_alerts",
    f"""WITH {DAILY_METRICS_SQL}, t AS (SELECT * FROM (VALUES ('mean', 9.0::DOUBLE, 11.0::DOUBLE, 'data'), ('errors', NULL, 60.0::DOUBLE, 'platform')) v(metric, min, max, owner))
    SELECT day, metric, value, min, max, owner FROM m JOIN t USING (metric) WHERE value > max OR value < min""",
)
def val_16(spark, d):
    return V.threshold_alerts(daily_metrics(tune(spark), d), THRESHOLDS)


@query(
    "val_17_batch_test_report",
    f"WITH {DAILY_METRICS_SQL} SELECT day, count(*) FILTER (CASE metric WHEN 'mean' THEN value BETWEEN 9 AND 11 ELSE value <= 70 END) AS passed, count(*) AS tests FROM m GROUP BY 1",
)
def val_17(spark, d):
    report = V.test_report(daily_metrics(tune(spark), d), {"mean": (9.0, 11.0), "errors": (None, 70.0)})
    return report.groupBy("day").agg(F.count_if("passed").alias("passed"), F.count(F.lit(1)).alias("tests"))
