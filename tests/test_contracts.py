import json

import pytest
from pyspark.sql import functions as F

from truegrain.functions.scalars import gtin13_valid
from truegrain.operators import documents as doc
from truegrain.operators import validate as V
from truegrain.plans import contract as C
from truegrain.plans import expectations as X

LOAD = C.from_dict(
    {
        "name": "products",
        "fields": {
            "id": {"type": "bigint", "required": True, "unique": True},
            "gtin": {"required": True, "min_length": 13, "max_length": 13, "unique": True},
            "name": {"required": True},
            "category": {"required": True},
            "price": {"type": "decimal(10,2)", "required": True, "minimum": 0},
            "stock": {"type": "double", "required": True},
            "unit": {"allowed": ["count", "kg", "liter"]},
            "supplier": {"type": "bigint", "required": True},
        },
        "foreign_keys": [("supplier", "suppliers", "id")],
        "row_checks": [("produce unit", lambda: (F.col("category") != "produce") | F.col("unit").isin("count", "kg"))],
    }
)
COLUMNS = "line bigint, id string, gtin string, name string, category string, price string, stock string, unit string, supplier string"
BATCH = [
    (1, "61", "0700000000061", "Pear", "produce", "2.50", "12", "kg", "1"),
    (2, "62", "0700000000062", "Plum", "produce", "1.50", "8", "kg", "2"),
    (3, "63", "0700000000063", "Leek", "produce", "0.99", "75.5", "count", "1"),
    (4, "1", "0700000000064", "Apple", "produce", "3.00", "5", "kg", "1"),
    (5, "65", "0700000000001", "Apple", "produce", "3.00", "5", "kg", "1"),
    (6, "66", "0700000000066", "Kale", "produce", "3.00", "5", "kg", "502"),
    (7, "67", "0700000000067", "Figs", "produce", "3.00", "5", "kg", "283"),
    (8, "68", "0700000000068", "Chard", "produce", "3.00", "5", "lbs", "1"),
    (9, "69", "0700000000069", "Mint", "produce", "-3.00", "5", "kg", "1"),
    (10, "70", "0700000000070", None, "produce", "3.00", "5", "kg", "1"),
    (11, "71", "0700000000071", "Juice", "produce", "3.00", "5", "liter", "1"),
    (12, "72", "0700000000072", "Rice", "pantry", "2,99", "5", "count", "1"),
    (13, "73", "0700000000073", "Oats", "pantry", "2.99", "many", "count", "1"),
    (14, "74", "070000000007", "Salt", "pantry", "2.99", "5", "count", "1"),
]


@pytest.fixture(scope="module")
def load(spark):
    batch = spark.createDataFrame(BATCH, COLUMNS)
    existing = spark.createDataFrame([("1", "0700000000001")], "id string, gtin string")
    suppliers = spark.createDataFrame([(1,), (2,)], "id bigint")
    return batch, existing, {"suppliers": suppliers}


def test_ddl_load_accepts_three_of_fourteen(load):
    batch, existing, parents = load
    out = {r.line: (r.error, r.reason) for r in V.ddl_load(batch, existing, LOAD, ["line"], parents).collect()}
    assert sorted(k for k, v in out.items() if v[0] is None) == [1, 2, 3]
    assert out[4][1] == "id duplicate key" and out[5][1] == "gtin duplicate key"
    assert out[6][1] == out[7][1] == "supplier exists in suppliers"
    assert out[12] == ("conversion", "price type decimal(10,2)") and out[13][0] == "conversion"


def test_ddl_load_sees_earlier_rows_of_the_batch(load, spark):
    _, existing, parents = load
    rows = [BATCH[0], (2, "61", "0700000000099", "Pear", "produce", "2.50", "12", "kg", "1"), (3, "88", "0700000000099", "Pear", "produce", "2.50", "12", "kg", "1")]
    out = V.ddl_load(spark.createDataFrame(rows, COLUMNS), existing, LOAD, ["line"], parents)
    assert {r.line: r.reason for r in out.collect()} == {1: None, 2: "id duplicate key", 3: None}


def test_gate_refuses_the_whole_batch(load):
    batch, _, parents = load
    with pytest.raises(V.BatchRefused):
        V.atomic_gate(batch, LOAD, parents)
    assert V.atomic_gate(batch.filter("line <= 3"), LOAD, parents).count() == 3

    @V.requires(LOAD, parents)
    def count(df):
        return df.count()

    assert count(batch.filter("line <= 3")) == 3
    with pytest.raises(V.BatchRefused):
        count(batch)


def test_validate_on_write(load, tmp_path):
    batch, _, parents = load
    contract = C.TableContract("t", (C.FieldRule("line", "bigint", required=True), C.FieldRule("id"), C.FieldRule("unit", allowed=("kg",))), allow_extra=False)
    good = batch.filter("line <= 2").select("line", "id", "unit")
    V.validate_on_write(good, contract, str(tmp_path / "ok"))
    for bad in (good.withColumn("x", F.lit(1)), good.drop("line"), good.withColumn("line", F.col("id")), batch.select("line", "id", "unit")):
        with pytest.raises(V.BatchRefused):
            V.validate_on_write(bad, contract, str(tmp_path / "no"))


def test_quarantine_flags_all_members_and_repeats(spark):
    contract = C.TableContract("t", (C.FieldRule("id", "bigint", unique=True), C.FieldRule("v", "double", minimum=0)))
    df = spark.createDataFrame([("1", "5"), ("1", "7"), ("2", "-1"), ("3", "x"), ("4", "2"), (None, "3"), (None, "4")], "id string, v string")
    good, bad = V.quarantine(df, contract, passes=2)
    assert sorted(r.v for r in good.collect()) == ["2", "3", "4"]
    assert {r.v: r.reason for r in bad.collect()}["x"] == "v type double [x]"
    assert bad.count() == 4


PACKAGE = """
resources:
  - name: products
    path: products.csv
    schema:
      fields:
        - {name: ProductID, type: integer, constraints: {required: true, minimum: 1}}
        - {name: Product Name, type: string, constraints: {required: true, minLength: 1}}
        - {name: Quantity, type: number, constraints: {required: true, minimum: 0}}
        - {name: Unit, type: string, constraints: {required: true, enum: [count, kg, liter]}}
        - {name: SupplierID, type: integer, constraints: {required: true}}
      primaryKey: [ProductID]
      foreignKeys:
        - {fields: [SupplierID], reference: {resource: suppliers, fields: [id]}}
"""


def test_package_with_nine_kinds_of_errors(spark):
    contract = C.from_package_yaml(PACKAGE)["products"]
    rows = [
        (1, "11", "Kiwi", "75.5", "kg", "502"), (2, "12", "Lime", "30", "count", "283"), (3, "13", "Date", "7O", "kg", "1"),
        (4, "14", "Beet", "-4", "kg", "1"), (5, "15", None, "14", "count", "1"), (6, "16", "Pea", "48", "lbs", "1"),
        (7, "16", "Pea", "48", "kg", "1"), (8, "17", "Yam", None, "kg", "1"), (9, "18", "Nut", "3", "kg", "1"),
    ]
    df = spark.createDataFrame(rows, "line int, ProductID string, `Product Name` string, Quantity string, Unit string, SupplierID string")
    out = V.validate(df.drop("line").withColumn("extra", F.when(F.col("ProductID") == "18", "Farm")), contract, ["ProductID"], {"suppliers": spark.createDataFrame([(1,)], "id bigint")})
    found = sorted((r["column"], r["check"]) for r in out.collect())
    assert found == sorted([
        ("SupplierID", "exists in suppliers"), ("SupplierID", "exists in suppliers"), ("Quantity", "type double"), ("Quantity", ">= 0"),
        ("Product Name", "required"), ("Unit", "in set"), ("ProductID", "unique"), ("ProductID", "unique"), ("Quantity", "required"), ("extra", "unexpected column"),
    ])


FEED = {
    "type": "array",
    "items": {
        "type": "object", "required": ["supplier", "gtin", "name", "pack", "price"], "additionalProperties": False,
        "properties": {
            "supplier": {"type": "integer"}, "gtin": {"type": "string", "pattern": "^[0-9]{13}$"}, "name": {"type": "string", "minLength": 1},
            "pack": {"type": "object", "required": ["size", "unit"], "properties": {"size": {"type": "number", "exclusiveMinimum": 0}, "unit": {"enum": ["count", "kg", "liter"]}}},
            "price": {"type": "number", "exclusiveMinimum": 0},
        },
    },
}


def test_nested_feed(spark):
    ok = {"supplier": 1, "gtin": "0700000000011", "name": "Kiwi", "pack": {"size": 1, "unit": "kg"}, "price": 2.5}
    records = [
        ok,
        {**ok, "pack": {"size": "1 lb", "unit": "lb"}},
        {**ok, "supplier": "one", "gtin": 700, "price": "2.50"},
        {**{k: v for k, v in ok.items() if k != "name"}, "title": "Kiwi"},
        {**ok, "pack": {"organic": True}, "organic": True},
    ]
    df = spark.createDataFrame([("f", json.dumps(records))], "file string, body string")
    found = sorted((r["index"], r.path, r.check) for r in doc.validate_feed(df, "body", FEED, ["file"]).collect())
    assert found == [
        (1, "pack/size", "type number"), (1, "pack/unit", "enum"), (2, "gtin", "type string"), (2, "price", "type number"),
        (2, "supplier", "type integer"), (3, "name", "required"), (3, "title", "unexpected"), (4, "organic", "unexpected"),
        (4, "pack/size", "required"), (4, "pack/unit", "required"),
    ]


def notice(items, **more):
    return json.dumps({"supplier": "S", "store_city": "Erie", "delivery_date": "2025-06-05", "items": items, **more})


def test_notices_with_retry(spark):
    kiwi = {"product": "Kiwi", "quantity": 3, "unit": "count"}
    first = [
        ("a", notice([kiwi])), ("b", notice([{**kiwi, "unit": "lbs"}])), ("c", notice([{**kiwi, "quantity": 0.5}])),
        ("d", notice([kiwi])[:-1]), ("e", notice([{**kiwi, "product": "Unheard of"}])),
    ]
    retry = [("b", notice([{**kiwi, "unit": "kg", "quantity": 1.5}])), ("c", notice([{**kiwi, "quantity": 0.5}])), ("d", notice([kiwi]))]
    frame = lambda rows: spark.createDataFrame(rows, "mail string, answer string")
    judged = doc.validate_with_retry(frame(first), frame(retry), "mail")
    catalog = spark.createDataFrame([(1, "Kiwi")], "id bigint, name string")
    out = {r.mail: (r.status, r.problems) for r in doc.quarantine_unknown_items(judged, "mail", catalog, "name", "id").collect()}
    assert [out[k][0] for k in "abcde"] == ["ok", "ok after retry", "quarantined", "ok after retry", "quarantined"]
    assert out["c"][1] == "items.0.quantity: whole number for count"
    assert out["e"][1] == "not in the catalog: Unheard of"


def test_notice_lists_all_errors(spark):
    bad = notice([{"product": "Kiwi", "quantity": -1, "unit": "lbs"}], delivery_date="June 5", note="x")
    df = spark.createDataFrame([(bad,)], "answer string").select(F.try_parse_json("answer").alias("d")).select(F.explode(doc.notice_errors("d")).alias("e"))
    assert sorted(r.e.path for r in df.collect()) == ["delivery_date", "items.0.quantity", "items.0.unit", "note"]


def test_findings(spark):
    ok = dict(name="Green Kiwi", gtin="0702010001014", category="produce", unit="kg", unit_price=3.5, supplier_id=1, case_pack=18,
              case_length_cm=50.0, case_width_cm=33.5, case_height_cm=27.0, unit_weight_kg=1.0, shelf_life_days=7)
    cases = [
        ("good", {**ok, "name": "Dragon Fruit"}), ("inches", {**ok, "name": "Lychee", "case_length_cm": 19.9, "case_width_cm": 13.0, "case_height_cm": 10.6}),
        ("schema", {**ok, "gtin": "070201000101", "unit": "liter"}), ("unit", {**ok, "name": "Rambutan", "unit": "liter"}),
        ("twin", {**ok, "name": "Kiwis Green"}),
    ]
    df = spark.createDataFrame([{"entry": n, **v} for n, v in cases])
    catalog = spark.createDataFrame([(9, "Green Kiwi", "0700000000000")], "id bigint, name string, gtin string")
    out = {r.entry: r for r in doc.findings(df, catalog, {"produce": 0.5}, "entry").collect()}
    assert {k: r.status for k, r in out.items()} == {
        "good": "accepted", "inches": "needs review", "schema": "blocked", "unit": "blocked", "twin": "needs review"
    }
    assert [f.field for f in out["schema"].findings] == ["gtin"]
    assert "6.6 kg per liter" in out["inches"].findings[0].message
    assert "95 % similar" in out["twin"].findings[0].message
    assert df.filter(~gtin13_valid("gtin")).count() == 1


def test_learned_contract_and_loaders(spark):
    df = spark.createDataFrame([(1.0, "kg"), (9.0, "count")], "q double, unit string")
    learned = C.learn(df)
    assert learned.field("q").minimum == 1.0 and learned.field("q").maximum == 9.0
    assert learned.field("unit").allowed == ("count", "kg")
    new = spark.createDataFrame([(1, 10.0, "kg"), (2, 2.0, "lbs"), (3, 2.0, "kg")], "id int, q double, unit string")
    assert sorted((r.id, r["column"]) for r in V.validate(new, learned, ["id"]).collect()) == [(1, "q"), (2, "unit")]
    schema = C.from_json_schema("t", {"properties": {"a": {"type": "integer", "exclusiveMinimum": 0}}, "required": ["a"], "additionalProperties": False})
    assert schema.field("a").above == 0 and schema.field("a").required and not schema.allow_extra


def test_expectations(spark):
    df = spark.createDataFrame([(1, 5.0, "kg"), (2, -1.0, "lbs"), (2, 900.0, None)], "id bigint, q double, unit string")
    suite = [X.of_type("q", "double"), X.unique("id"), X.between("q", 0), X.in_set("unit", ["kg"]), X.median_between("q", 4, 6), X.max_at_most("q", 100)]
    out = {(r.expectation, r.column_name): (r.success, r.unexpected) for r in X.expect(df, suite).collect()}
    assert out == {
        ("type", "q"): (True, None), ("unique", "id"): (False, 2), ("between", "q"): (False, 1), ("in set", "unit"): (False, 1),
        ("median", "q"): (True, None), ("max", "q"): (False, None),
    }
    examples = {r.column_name: r.examples for r in X.unexpected_examples(df, suite).collect()}
    assert examples == {"id": ["2"], "q": ["-1.0"], "unit": ["lbs"]}
    assert X.unexpected_rows(df, suite[1]).count() == 2


def test_load_with_two_keys_admits_rows_whose_blocker_was_refused(spark):
    contract = C.from_dict({"name": "items", "fields": {"id": {"type": "bigint", "required": True, "unique": True}, "code": {"unique": True}}})
    rows = [(1, "5", "X"), (2, "5", "B"), (3, "6", "B"), (4, "7", None), (5, "8", None), (6, "5", "C"), (7, "9", "C"), (8, None, "D"), (9, "10", "D"), (10, "10", "E"), (11, "11", "E")]
    batch = spark.createDataFrame(rows, "line bigint, id string, code string")
    existing = spark.createDataFrame([(1, "X"), (2, None)], "id bigint, code string")
    got = {r.line: r.reason for r in V.ddl_load(batch, existing, contract, ["line"]).collect()}
    ids, codes, plain = {1}, {"X"}, {}
    for line, i, code in rows:
        if i is None:
            plain[line] = "id required"
        elif int(i) in ids:
            plain[line] = "id duplicate key"
        elif code in codes:
            plain[line] = "code duplicate key"
        else:
            plain[line] = None
            ids.add(int(i))
            codes |= {code} - {None}
    assert got == plain


def test_learned_sets_do_not_depend_on_an_estimate(spark):
    df = spark.createDataFrame([(f"v{i % 20}", f"w{i % 21}") for i in range(500)], "few string, many string")
    fields = {f.name: f.allowed for f in C.learn(df, "t", 20).fields}
    assert len(fields["few"]) == 20 and fields["many"] is None
