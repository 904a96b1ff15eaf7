"""Repairs of the retail view as cell edits."""

from pyspark.sql import functions as F

from queries import query
from queries.joins import UNIT_SPELLINGS
from queries.predicates import events, part
from queries.retail import CTES, Retail
from truegrain.functions.scalars import pad_code
from truegrain.operators import repair as R


@query(
    "rep_01_from_reference",
    CTES + """SELECT s.id::VARCHAR AS row_id, s.city AS old_value, z.city AS new_value FROM stores s JOIN zip_codes z ON lpad(s.zip, 5, '0') = z.zip WHERE s.city IS DISTINCT FROM z.city""",
)
def rep_01(spark, d):
    t = Retail(spark, d)
    z = t["zip_codes"].select(F.col("zip").alias("_zip"), F.col("city").alias("_city"))
    out = R.repair_from_reference(t["stores"], z, pad_code("zip", 5) == F.col("_zip"), "id", "city", "_city")
    return out.select("row_id", "old_value", "new_value")


@query(
    "rep_02_by_mapping",
    CTES + """SELECT delivery_id::VARCHAR AS row_id, unit AS old_value, CASE unit WHEN 'Kg' THEN 'kg' ELSE 'count' END AS new_value FROM deliveries WHERE unit IN ('Kg', 'ct')""",
)
def rep_02(spark, d):
    return R.repair_by_mapping(Retail(spark, d)["deliveries"], "delivery_id", "unit", UNIT_SPELLINGS).select("row_id", "old_value", "new_value")


@query("rep_03_fuzzy_repair")
def rep_03(spark, d):
    t = Retail(spark, d)
    return R.repair_fuzzy(t["deliveries"], "delivery_id", "product_name", "product_id", t["catalog"], "name", "id", suggest=None).withColumn(
        "similarity", F.round("similarity", 6)
    )


ENTITY = ["product_id", "product_name", "category", "unit", "supplier_id"]
SUPPORT = 5  # a product has about ten deliveries


@query("rep_04_by_frequency")
def rep_04(spark, d):
    deliveries = Retail(spark, d).shuffled("catalog")["deliveries"]
    return R.repair_by_frequency(deliveries, "delivery_id", ENTITY, min_support=SUPPORT).withColumn("p", F.round("p", 6))


def _frequency_sql(p="round(b.p, 6)"):
    same = lambda c: f"r.{c} IS NOT DISTINCT FROM f.{c}"
    differing = " + ".join(f"(NOT ({same(c)}))::INT" for c in ENTITY)
    logp = "ln(f.support::DOUBLE) + " + " + ".join(f"CASE WHEN {same(c)} THEN ln(0.99::DOUBLE) ELSE ln(0.01::DOUBLE * 0.5::DOUBLE) END" for c in ENTITY)
    cols = ", ".join(ENTITY)
    text = ", ".join(f"{c}::VARCHAR AS {c}" for c in ENTITY)
    order = ", ".join(f"f_{c} DESC" for c in ENTITY)
    cells = " UNION ALL ".join(
        f"SELECT t.delivery_id::VARCHAR AS row_id, '{c}' AS \"column\", t.{c} AS old_value, b.f_{c} AS new_value, {p} AS p FROM t JOIN best b USING ({cols}) WHERE t.{c} IS DISTINCT FROM b.f_{c}"
        for c in ENTITY
    )
    return f"""{CTES}, t AS (SELECT delivery_id, {text} FROM deliveries), c AS (SELECT {cols}, count(*) AS support FROM t GROUP BY ALL),
    r AS (SELECT * FROM c WHERE support < {SUPPORT}), f AS (SELECT * FROM c WHERE support >= {SUPPORT}),
    cand AS (SELECT {", ".join(f"r.{c}" for c in ENTITY)}, {", ".join(f"f.{c} AS f_{c}" for c in ENTITY)}, {logp} AS logp FROM r JOIN f ON {differing} <= 2),
    scored AS (SELECT *, max(logp) OVER (PARTITION BY {cols}) AS top, row_number() OVER (PARTITION BY {cols} ORDER BY logp DESC, {order}) AS place FROM cand),
    z AS (SELECT {cols}, 1 / sum(exp(logp - top)) AS p FROM scored GROUP BY {cols}),
    best AS (SELECT s.*, z.p FROM scored s JOIN z USING ({cols}) WHERE place = 1)
    {cells}"""


@query("rep_04_constant_similarity", _frequency_sql())
def rep_04_constant(spark, d):
    out = R.repair_by_frequency(Retail(spark, d)["deliveries"], "delivery_id", ENTITY, min_support=SUPPORT, constant_similarity=0.5, pairs=True)
    return out.select("row_id", "column", "old_value", "new_value", F.round("p", 6).alias("p"))


@query("rep_04_support_sums", _frequency_sql("round(round(b.p, 12), 6)"))
def rep_04_sums(spark, d):
    """As rep_04_constant_similarity, from sums per agreeing column subset in place of pairs."""
    out = R.repair_by_frequency(Retail(spark, d)["deliveries"], "delivery_id", ENTITY, min_support=SUPPORT, constant_similarity=0.5)
    return out.select("row_id", "column", "old_value", "new_value", F.round("p", 6).alias("p"))


@query(
    "rep_05_score_repairs",
    CTES + """, e AS (SELECT delivery_id, CASE unit WHEN 'Kg' THEN 'kg' ELSE 'count' END AS new_value FROM deliveries WHERE unit IN ('Kg', 'ct')),
    right_units AS (SELECT o_orderkey AS delivery_id, c.unit FROM orders JOIN catalog c ON o_custkey + 101 = c.id)
    SELECT 'unit' AS "column", count(*) AS edits, count(*) FILTER (new_value IS NOT DISTINCT FROM unit) AS correct, count(*) FILTER (new_value IS DISTINCT FROM unit) AS wrong FROM e LEFT JOIN right_units USING (delivery_id)""",
)
def rep_05(spark, d):
    t = Retail(spark, d)
    edits = R.repair_by_mapping(t["deliveries"], "delivery_id", "unit", UNIT_SPELLINGS)
    c = t["catalog"].select(F.col("id").alias("cid"), "unit")
    clean = t._raw("orders").withColumn("cid", F.col("o_custkey") + 101).join(c, "cid").select(F.col("o_orderkey").alias("delivery_id"), "unit")
    return R.score_repairs(edits, clean, "delivery_id", ["unit"])


@query("rep_06_placeholder_to_null", CTES + "SELECT id::VARCHAR AS row_id, contact_phone AS old_value, NULL::VARCHAR AS new_value FROM suppliers WHERE contact_phone IN ('999-9999999', '000-0000000')")
def rep_06(spark, d):
    out = R.repair_placeholder(Retail(spark, d)["suppliers"], "id", "contact_phone", ["999-9999999", "000-0000000"])
    return out.select("row_id", "old_value", "new_value")


@query(
    "rep_07_unit_repair",
    """SELECT event_type, round(sum(CASE WHEN user_id % 8 IN (6, 7) AND ts >= TIMESTAMP '2024-01-15' THEN value / 2.20462 ELSE value END), 4) AS kg FROM events GROUP BY 1""",
)
def rep_07(spark, d):
    rule = ("value", (F.col("user_id") % 8).isin(6, 7) & (F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")), 1 / 2.20462, 0.0)
    return R.repair_units(events(spark, d), [rule]).groupBy("event_type").agg(F.round(F.sum("value"), 4).alias("kg"))


@query(
    "rep_08_apply_edits",
    CTES + """SELECT id, unit, contact FROM (SELECT delivery_id AS id, CASE unit WHEN 'Kg' THEN 'kg' WHEN 'ct' THEN 'count' ELSE unit END AS unit, CASE WHEN quantity < 0 THEN NULL ELSE quantity END AS contact FROM deliveries)""",
)
def rep_08(spark, d):
    rows = Retail(spark, d)["deliveries"].select(F.col("delivery_id").alias("id"), "unit", F.col("quantity").alias("contact"))
    edits = R.repair_by_mapping(rows, "id", "unit", UNIT_SPELLINGS).unionByName(
        R.as_edits(rows.filter("contact < 0"), "id", "contact", F.lit(None).cast("double"), "negative")
    )
    return R.apply_edits(rows, edits, "id", ["unit", "contact"])


@query("udf_06_scorer_parameter")
def udf_06(spark, d):
    """The scorer of the nearest-name match is a parameter (a pandas UDF or any Column function)."""
    from truegrain.operators.match import nearest

    t = Retail(spark, d)
    names = part(spark, d).groupBy("p_name").agg(F.min("p_partkey").alias("id"))
    strict = lambda a, b: F.when(a == b, F.lit(100.0)).otherwise(F.lit(0.0))
    return nearest(t["products"].select(F.col("name").alias("value")), "value", names, "p_name", "id", 90.0, scorer=strict)
