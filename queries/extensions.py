"""User extension points: SQL functions, column checks, row checks, named aggregates."""

from pyspark.sql import functions as F

from queries import query
from queries.predicates import lineitem
from queries.retail import CTES, Retail
from truegrain.functions import sql
from truegrain.functions.scalars import gtin13_valid
from truegrain.operators.aggregates import regression_metrics
from truegrain.operators.validate import validate
from truegrain.plans.contract import FieldRule, TableContract

VALID_SQL = """(regexp_full_match(gtin, '[0-9]{13}')
    AND (10 - list_sum(list_transform(range(1, 13), lambda i: try_cast(substr(gtin, i::INT, 1) AS INT) * CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END)) % 10) % 10 = try_cast(substr(gtin, 13, 1) AS INT))"""


@query("udf_01_sql_function", CTES + f"SELECT id FROM products WHERE NOT {VALID_SQL}")
def udf_01(spark, d):
    """The check digit as a SQL function, called from SQL text over a view."""
    Retail(spark, d)["products"].createOrReplaceTempView("products_view")
    sql.register(spark)
    return spark.sql("SELECT id FROM products_view WHERE NOT gtin13_valid(pad_code(gtin, 13))")


@query("udf_02_column_check", CTES + f"SELECT id, 'check digit' AS \"check\", gtin AS value FROM products WHERE NOT {VALID_SQL}")
def udf_02(spark, d):
    contract = TableContract("products", (FieldRule("gtin", checks=(("check digit", gtin13_valid),)),))
    return validate(Retail(spark, d)["products"], contract, ["id"]).select("id", "check", "value")


@query("udf_03_row_check", CTES + "SELECT id, 'refill is liquid' AS \"check\" FROM products WHERE category = 'refill' AND unit <> 'liter'")
def udf_03(spark, d):
    rule = ("refill is liquid", lambda: (F.col("category") != "refill") | (F.col("unit") == "liter"))
    contract = TableContract("products", (), row_checks=(rule,))
    return validate(Retail(spark, d)["products"], contract, ["id"]).select("id", "check")


@query(
    "udf_04_named_aggregates",
    "SELECT l_linestatus, round(avg(abs(l_tax - l_discount)), 8) AS mae, round(avg(l_tax - l_discount), 8) AS mean_error, round(sum(abs(l_tax - l_discount)) / sum(l_discount), 8) AS wape FROM lineitem GROUP BY 1",
)
def udf_04(spark, d):
    named = {n: F.round(c, 8) for n, c in regression_metrics("l_discount", "l_tax").items()}
    return lineitem(spark, d).groupBy("l_linestatus").agg(*[c.alias(n) for n, c in named.items()])
