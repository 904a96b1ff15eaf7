import random

import pytest
from pyspark.sql import functions as F

from truegrain.functions import predicates as P
from truegrain.functions import scalars as S
from truegrain.functions.similarity import indel_percent, indel_ratio, lcs_length, token_sort_ratio


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_lcs_matches_dynamic_programming():
    rng = random.Random(1)
    for _ in range(300):
        a = "".join(rng.choice("abcé ") for _ in range(rng.randrange(0, 12)))
        b = "".join(rng.choice("abcé ") for _ in range(rng.randrange(0, 12)))
        assert lcs_length(a, b) == slow_lcs(a, b)


def test_similarity_columns(spark):
    row = spark.createDataFrame([("Bananas Organic", "Organic Banana")], "a string, b string").select(
        F.round(token_sort_ratio("a", "b")).alias("t"), indel_ratio("a", "b").alias("r")
    ).first()
    assert row.t == 97
    assert row.r == pytest.approx(indel_percent("Bananas Organic", "Organic Banana"))


@pytest.mark.parametrize(
    "code, valid",
    [("4006381333931", True), ("4006381333932", False), ("400638133393", False), ("40063813339X1", False), (None, False)],
)
def test_gtin(spark, code, valid):
    df = spark.createDataFrame([(code,)], "g string")
    assert df.select(S.gtin13_valid("g").alias("v")).first().v is valid


def test_codes_and_formats(spark):
    df = spark.createDataFrame([(7, "7O", "38,2"), (123456, "N/A", "12.5")], "n bigint, a string, b string")
    rows = df.select(
        S.pad_code("n", 5).alias("p"), S.number_format("a").alias("a"), S.number_format("b").alias("b")
    ).collect()
    assert [(r.p, r.a, r.b) for r in rows] == [
        ("00007", "letter for digit", "decimal comma"),
        ("123456", "missing", "number"),
    ]
    made = spark.range(1).select(S.gtin13_valid(S.make_gtin13(F.lit(201), F.lit(101))).alias("v")).first().v
    assert made


def test_codes_of_numbers_that_outgrow_their_places(spark):
    row = spark.range(1).select(S.make_gtin13(F.lit(5), F.lit(1000000)).alias("long"), S.make_gtin13(F.lit(5), F.lit(100000)).alias("short")).first()
    assert row.long == row.short and len(row.long) == 13


def test_full_codes_tell_products_of_equal_digits_apart(spark):
    from queries.retail import Retail
    from queries.rulebook import rulebook
    from truegrain.plans.rules import run_rules

    class Long(Retail):
        def _raw(self, name):  # ids 100000 and 1000000, 100006 and 1000066 (both with X), 114 and 174 (one code)
            return spark.createDataFrame([(i - 101, "n", "b", 1, 1.0) for i in (100000, 1000000, 100006, 1000066, 114, 174)],
                                         "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double")

    t = Long(spark, "")
    codes = {r.id: r.gtin for r in t["products"].collect()}
    assert codes[100000] == codes[1000000] and codes[100006] == codes[1000066] == codes[100006][:12] + "X"
    rule = [r for r in rulebook(("1995-01-01", "2001-12-31"), "full_codes") if r.name == "code used once"]
    assert [(r.table_name, r.row_id) for r in run_rules(t, rule).collect()] == [("products", "174")]


def test_dates(spark):
    df = spark.createDataFrame([("06/03/2025",), ("2025-06-03",), ("25/06/2025",), ("3.6.2025",)], "d string")
    rows = df.select(S.parse_mixed_dates("d").cast("string").alias("p"), S.ambiguous_date("d").alias("a")).collect()
    assert [(r.p, r.a) for r in rows] == [
        ("2025-06-03", True), ("2025-06-03", False), (None, False), ("2025-06-03", False)
    ]


def test_predicates_null_and_bounds(spark):
    df = spark.createDataFrame([("5", 1.0), ("-1", 5.0), (None, None), ("x", 10.0)], "t string, v double")
    out = df.select(
        P.parses_positive("t").alias("p"), P.in_range("v", 1, 10, True, False).alias("r"), P.lossy_cast("t").alias("l")
    ).collect()
    assert [r.p for r in out] == [True, False, False, False]
    assert [r.r for r in out] == [True, True, None, False]
    assert P.type_is(df, "v", "double") and not P.type_is(df, "t", "double")
    lossy = spark.createDataFrame([("75.5",), ("75",), ("many",)], "t string").select(P.lossy_cast("t").alias("l"))
    assert [r.l for r in lossy.collect()] == [True, False, False]


def test_density(spark):
    inches = spark.range(1).select(
        F.round(S.case_density(F.lit(19.9), F.lit(13.0), F.lit(10.6), F.lit(1.0), F.lit(18)), 1).alias("d"),
        S.density_plausibility(S.case_density(F.lit(19.9), F.lit(13.0), F.lit(10.6), F.lit(1.0), F.lit(18)), F.lit(0.5)).alias("v"),
    ).first()
    assert (inches.d, inches.v) == (6.6, "inches")
