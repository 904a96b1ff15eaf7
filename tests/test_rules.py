import datetime as dt

import pytest

from truegrain.functions.scalars import make_gtin13
from truegrain.operators.ranks import running
from queries.rulebook import ORIGINS, checkbook, rulebook
from truegrain.plans.checks import measure_checks, scorecard
from truegrain.plans.rules import agrees, rule_report, run_rules
from pyspark.sql import functions as F

PERIOD = ("2024-01-01", "2025-12-31")


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    products = make(
        [
            (1, "Kiwi", "produce", "kg", "2.00", 10, "7", "k", 1.0), (2, "Kiwi 3", "produce", "liter", "1.50", 10, "7", "k", 3.0),
            (3, "Soap", "refill", "liter", "N/A", 99, "9999", None, None), (4, "Salt", None, "kg", "3.00", 10, "0", "k", 2.0),
        ],
        "id bigint, name string, category string, unit string, unit_price string, supplier_id bigint, shelf_life_days string, family string, size double",
    )
    good = make_gtin13("supplier_id", F.when(F.col("id") == 4, 1).otherwise(F.col("id")))
    products = products.withColumn("gtin", F.when(F.col("id") == 3, F.concat(F.substring(good, 1, 12), F.lit("x"))).otherwise(F.when(F.col("id") == 4, make_gtin13(F.lit(10), F.lit(1))).otherwise(good)))
    day = lambda n: dt.date(2025, 3, n)
    deliveries = make(
        [
            (1, 1, 1, 10, "Kiwi", 5.0, "kg", day(1), dt.datetime(2025, 3, 1, 8), dt.datetime(2025, 3, 1, 9)),
            (2, 1, 1, 10, "Kiwi", 5.0, "kg", day(1), dt.datetime(2025, 3, 1, 8), dt.datetime(2025, 3, 2, 9)),
            (3, 1, 2, 10, "Kiwi", 2.0, "Kg", dt.date(1900, 1, 1), dt.datetime(2025, 3, 1, 8), dt.datetime(2025, 3, 1, 8)),
        ],
        "delivery_id bigint, store_id bigint, product_id bigint, supplier_id bigint, product_name string, quantity double, unit string, delivery_date date, received_at timestamp_ntz, entered_at timestamp_ntz",
    )
    sales = make(
        [(day(1), 1, 1, 3.0, 2.0, False), (day(2), 1, 1, 12.0, 1.5, False), (day(2), 1, 2, 1.0, 9.0, True)],
        "date date, store_id bigint, product_id bigint, quantity double, unit_price double, promo boolean",
    )
    cells = "date date, store_id bigint, product_id bigint"
    return {
        "products": products,
        "suppliers": make([(10, "A", "412-555-0101"), (11, "B", "999-9999999")], "id bigint, name string, contact_phone string"),
        "stores": make([(1, "1234", "Erie"), (2, "01234", "Eire"), (3, "99999", "Erie")], "id bigint, zip string, city string"),
        "zip_codes": make([("01234", "Erie")], "zip string, city string"),
        "deliveries": deliveries,
        "sales": sales,
        "inventory": make([(day(1), 1, 1, 10.0), (day(2), 1, 1, 4.0)], f"{cells}, on_hand_system double"),
        "catalog": make([(1, "Kiwi", 2.0), (2, "Kiwi 3", 5.0)], "id bigint, name string, unit_price double"),
        "stock_counts": make([(day(1), 1, 1, 10.0), (day(2), 1, 1, 20.0)], f"{cells}, counted_qty double"),
        "stock_audit": make([(day(1), 1, 1, 10.4), (day(2), 1, 1, 10.0)], f"{cells}, audited_qty double"),
        "truth": make([(day(1), 1, 1, 2.0), (day(2), 1, 1, 0.0), (day(2), 1, 2, 1.0)], f"{cells}, lost double"),
        "oos_reports": make([(1, 1, 1, dt.datetime(2025, 3, 1, 12)), (2, 1, 1, dt.datetime(2025, 3, 2, 12))], "report_id bigint, store_id bigint, product_id bigint, reported_at timestamp_ntz"),
        "weather": make([(day(1), "S", 5.0), (day(2), "S", None), (day(1), "T", 99.0), (day(2), "T", 1.0)], "date date, station string, temp_c double"),
        "pos_events": make(
            [("a", dt.datetime(2025, 3, 1, 8), dt.datetime(2025, 3, 1, 8, 0, 5)), ("a", dt.datetime(2025, 3, 1, 8), dt.datetime(2025, 3, 1, 8, 5)), ("b", dt.datetime(2025, 3, 1, 12), dt.datetime(2025, 3, 1, 8))],
            "event_id string, event_time timestamp_ntz, ingested_at timestamp_ntz",
        ),
    }


def test_rules_find_their_rows(tables):
    found = {}
    for r in run_rules(tables, rulebook(PERIOD)).collect():
        found.setdefault(r.rule, []).append(r.row_id)
    assert {k: sorted(v) for k, v in found.items()} == {
        "city of the postal code": ["2", "3"],
        "known supplier": ["3"],
        "code used once": ["4"],
        "code has its check digit": ["3"],
        "sold by a unit of its category": ["2", "4"],
        "price grows with the pack": ["2"],
        "value is not a stand-in": ["11", "3", "4"],
        "name of the listed product": ["3"],
        "entered once": ["2"],
        "day within the books": ["3"],
        "sold from stock": ["2025-03-02|1|1"],
        "list price unless promoted": ["2025-03-02|1|1"],
    }


def test_report_counts_hits_once(tables, spark):
    log = spark.createDataFrame([("suppliers", "11"), ("products", "3"), ("products", "77")], "table_name string, row_id string")
    out = {r.rule: (r.violations, r.injected) for r in rule_report(run_rules(tables, rulebook(PERIOD)), log).collect()}
    assert out["value is not a stand-in"] == (3, 2) and out["known supplier"] == (1, 1)
    assert out["city of the postal code"] == (2, 0)


def test_scorecard(tables):
    scores = measure_checks(tables, checkbook(), ORIGINS)
    got = {(r.source, r.dimension, r.check_name): r.score for r in scores.collect()}
    assert len(got) == 21
    assert got[("stores", "consistency", "city of the postal code")] == 0.5  # the unknown ZIP does not count
    assert got[("deliveries", "uniqueness", "entered once")] == pytest.approx(2 / 3)
    assert got[("weather", "completeness", "all stations on all days")] == 0.75
    assert got[("stock_counts", "accuracy", "near the audit")] == 0.5
    assert got[("oos_reports", "accuracy", "shelf was empty")] == 0.5
    assert got[("oos_reports", "completeness", "empty shelf was reported")] == 0.5
    card = {r.source: r for r in scorecard(scores).collect()}
    assert card["pos_events"].validity == pytest.approx(2 / 3) and card["pos_events"].uniqueness == pytest.approx(2 / 3)


def test_denial_constraint_in_both_forms(spark):
    rows = [(i, "f" if i % 2 else "g", i % 17, float((i * 37) % 101)) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, family string, size bigint, price double")
    tops = df.groupBy("family", "size").agg(F.max("price").alias("top"))
    forms = [
        {(r.family, r.size): r.limit for r in running(tops, ["family"], "size", {"limit": ("max", "top")}, False, spread=s).collect()}
        for s in (False, True)
    ]
    assert forms[0] == forms[1]


def test_examples_of_missing_parents_and_repeated_keys(spark):
    from truegrain.plans.expectations import in_table, unexpected_examples, unique

    df = spark.createDataFrame([(1, 7), (1, 8), (2, None), (3, 9)], "id int, parent int")
    parents = spark.createDataFrame([(7,)], "key int")
    out = {r.expectation: r.examples for r in unexpected_examples(df, [in_table("parent", parents, "key"), unique("id")]).collect()}
    assert out == {"in table": ["8", "9"], "unique": ["1"]}


def test_agreement_with_unknown_matches(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", "x"), (4, "a", None)], "id int, key string, value string")
    known = {"rows": rows, "known": spark.createDataFrame([("a", "x")], "key string, value string")}
    make = lambda ok: agrees("r", "flag", "rows", "known", "key = other_key", "value = other_value", unknown_ok=ok)
    ids = lambda rule: sorted(r.row_id for r in run_rules(known, [rule]).collect())
    assert ids(make(True)) == ["2"] and ids(make(False)) == ["2", "3", "4"]


def test_distinct_checks_have_partitions_enough_for_large_tables(spark):
    """However few partitions the session starts with; small ones are joined while the query runs."""
    import re

    from truegrain.plans.checks import distinct_check

    table = spark.range(10).selectExpr("id AS a", "id % 3 AS b")
    frame = distinct_check("t", "one row a cell", "a", "b").frame({"t": table})
    dealt = re.findall(r"hashpartitioning\(.*?, (\d+)\)", frame._jdf.queryExecution().executedPlan().toString())
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert dealt and min(int(n) for n in dealt) >= 256
    assert frame.first().score == 1.0
