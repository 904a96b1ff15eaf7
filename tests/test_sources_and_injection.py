from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from truegrain.operators import diff
from truegrain.operators import inject as I
from truegrain.operators.windows import duplicate_members
from truegrain.plans.contract import FieldRule, TableContract
from truegrain.sources import evolution, readers, sinks
from truegrain.sources.profile import type_profile

V1 = TableContract("event", (FieldRule("id", required=True), FieldRule("at", "timestamp", required=True), FieldRule("quantity", "double", required=True), FieldRule("unit", required=True, allowed=("count", "kg")), FieldRule("terminal", required=True)))
V2 = TableContract("event", (*V1.fields, FieldRule("loyalty_id", "string", default=None)))
V3 = TableContract("event", tuple(FieldRule("quantity", "string", required=True) if f.name == "quantity" else FieldRule("register", required=True) if f.name == "terminal" else f for f in V1.fields))


def test_compatibility():
    assert evolution.compatibility(V1, V2)["verdict"] == "register"
    report = evolution.compatibility(V1, V3)
    assert not report["backward"] and not report["forward"] and report["verdict"] == "reject"


def test_written_nulls_stay(spark):
    """A default is for what was not written; a required field takes it for NULL too."""
    writer = TableContract("t", (FieldRule("a", "int"), FieldRule("b", "int")))
    reader = TableContract("t", (FieldRule("a", "bigint", default=7), FieldRule("b", "int", required=True, default=8), FieldRule("c", "int", default=9)))
    old = spark.createDataFrame([(None, None), (1, 2)], "a int, b int")
    assert sorted((tuple(r) for r in evolution.read_as(old, writer, reader).collect()), key=str) == [(1, 2, 9), (None, 8, 9)]


def test_read_as(spark):
    old = spark.createDataFrame([("a", 3)], "id string, n int")
    writer = TableContract("t", (FieldRule("id"), FieldRule("n", "int"), FieldRule("gone")))
    reader = TableContract("t", (FieldRule("n", "double"), FieldRule("promo", "boolean", required=True, default=False)))
    assert [tuple(r) for r in evolution.read_as(old, writer, reader).collect()] == [(3.0, False)]
    with pytest.raises(evolution.Incompatible):
        evolution.read_as(old, writer, TableContract("t", (FieldRule("n", "string"),)))


def test_registry_text_and_rejects(spark, tmp_path):
    root = tmp_path / "data"
    (root / "dirty").mkdir(parents=True)
    (root / "dirty" / "codes.csv").write_text("id,code\n1,007\n2,\n3,N/A\n")
    spark.range(3).write.parquet(str(root / "clean" / "codes.parquet"))
    assert readers.TableRegistry(spark, str(root), "clean").load("codes").count() == 3
    assert readers.TableRegistry(spark, str(root), "dirty").load("codes").count() == 3
    with pytest.raises(FileNotFoundError):
        readers.TableRegistry(spark, str(root), "drift").load("codes")
    text = readers.read_all_text(spark, str(root / "dirty" / "codes.csv"), ["id", "code"])
    assert [tuple(r) for r in text.orderBy("id").collect()] == [("1", "007"), ("2", None), ("3", "N/A")]
    assert [r.code for r in readers.normalize_nulls(text).orderBy("id").collect()] == ["007", None, None]
    path = tmp_path / "lines.csv"
    path.write_text("id,q\n1,5\n2,6,extra\n3,many\n")
    good, rejected = readers.read_csv_with_rejects(spark, str(path), "id int, q int")
    assert good.count() == 1 and sorted(r["_line"] for r in rejected.collect()) == ["2,6,extra", "3,many"]


def test_type_profile(spark):
    df = spark.createDataFrame([("1", "2025-01-01", "x"), ("2", "2025-01-02", None), ("7O", "", "true")], "a string, b string, c string")
    out = {r.column_name: r for r in type_profile(df).collect()}
    assert (out["a"].inferred, out["a"].bigint) == ("string", 2)
    assert (out["b"].inferred, out["b"].blanks) == ("date", 1)
    assert out["c"].nulls == 1


def test_sinks(spark, tmp_path):
    contract = TableContract("t", (FieldRule("q", "double", minimum=0),))
    df = spark.createDataFrame([(1, "2.5"), (2, "-1"), (3, "x")], "id int, q string")
    assert sinks.write_quarantine(df, contract, str(tmp_path / "good"), str(tmp_path / "bad")) == (1, 2)
    bad = spark.read.option("header", "true").csv(str(tmp_path / "bad"))
    assert {r.id: (r.error, r.reason) for r in bad.collect()} == {"2": ("constraint", "q >= 0 [-1]"), "3": ("conversion", "q type double [x]")}
    report = sinks.format_roundtrip_report(spark.createDataFrame([(1, Decimal("2.50"))], "id bigint, q decimal(10,2)"), folder=str(tmp_path / "f"))
    kept = {(r.format, r.column_name): r.kept for r in report.collect()}
    assert kept[("parquet", "q")] and not kept[("csv", "q")] and all(r.bytes > 0 for r in report.collect())
    sinks.write_jsonl(df, str(tmp_path / "alerts"))
    assert readers.read_table(spark, str(tmp_path / "alerts"), "json", "id int, q string").count() == 3


def test_injected_cells_are_exactly_the_logged_ones(spark):
    df = spark.range(5000).select("id", (F.col("id") % 50 + 1).cast("double").alias("q"), F.when(F.col("id") % 2 == 0, "kg").otherwise("count").alias("unit"))
    injectors = [
        I.Injector("q", "wrong_unit", I.scaled("q", 1000), share=0.02, where=lambda: F.col("unit") == "kg"),
        I.Injector("q", "illegal_value", I.scaled("q", -1.0), share=0.02),
        I.Injector("unit", "invalid_format", I.variant_of("unit", {"kg": ["Kg", "KG"], "count": ["ct"]}, "id"), share=0.02),
        I.Injector("unit", "misspelling", I.typo("unit", "id"), share=0.02),
    ]
    dirty, log = I.inject(df, "t", F.col("id"), injectors, ["id"], seed=3)
    changed = {(str(r.id), r["column"]) for r in diff.cell_diff(df, dirty, ["id"], ["q", "unit"]).collect()}
    logged = [(r.row_id, r["column"]) for r in log.collect()]
    assert changed == set(logged) and len(logged) == len(set(logged))
    assert len({r for r, _ in logged}) == len(logged)  # shares are disjoint: one error per row
    again, _ = I.inject(df.repartition(7), "t", F.col("id"), injectors, ["id"], seed=3)
    assert not diff.cell_diff(dirty, again, ["id"], ["q", "unit"]).count()


def test_row_injectors(spark):
    df = spark.range(100).select("id", F.lit(1.0).alias("q"))
    kept, log = I.drop_rows(df, "t", F.col("id"), F.col("id") < 5)
    assert (kept.count(), log.count()) == (95, 5)
    more, log = I.copy_rows(df, "t", "id", F.col("id") < 4, F.col("id") + 1000, near=F.col("id") == 0, near_values={"q": F.col("q") * 1.1})
    assert more.count() == 104 and {r.error_type for r in log.collect()} == {"near_duplicate", "duplicate_record"}
    twice, _ = I.double_upload(df, "t", F.col("id"), F.col("id") < 3)
    assert duplicate_members(twice, ["id", "q"]).count() == 6
    changes = diff.row_diff(df, kept.unionByName(df.filter("id = 9").withColumn("id", F.lit(500).cast("bigint"))), ["id"])
    assert {r.change: r.n for r in changes.groupBy("change").agg(F.count("*").alias("n")).collect()} == {"removed": 5, "added": 1}


def test_diff_ignores_equal_numbers_and_blank_nulls(spark):
    old = spark.createDataFrame([(1, "1.0", None), (2, "a", "x")], "id int, a string, b string")
    new = spark.createDataFrame([(1, "1", ""), (2, "a", None)], "id int, a string, b string")
    assert [tuple(r) for r in diff.cell_diff(old, new, ["id"], ["a", "b"]).collect()] == [(2, "b", "x", None)]


def test_next_existing_id(spark):
    from truegrain.operators import inject

    ids = spark.createDataFrame([(v,) for v in (7, 3, 100, 3, None, 55, -4)], "id long")
    assert {tuple(r) for r in inject.successors(ids, "id").collect()} == {(-4, 3), (3, 7), (7, 55), (55, 100), (100, -4)}
    assert [tuple(r) for r in inject.successors(ids.filter("id = 7"), "id").collect()] == [(7, 7)]
    names = spark.createDataFrame([("b",), ("a",), ("c",)], "id string")
    assert {tuple(r) for r in inject.successors(names, "id").collect()} == {("a", "b"), ("b", "c"), ("c", "a")}
    many = inject.successors(spark.range(0, 3000, 3), "id").collect()
    assert {(r.id, r.next_id) for r in many} == {(i, (i + 3) % 3000) for i in range(0, 3000, 3)}
    rows = spark.createDataFrame([(1, 100), (2, 8), (3, None)], "k int, ref long")
    dirty = inject.with_successor(rows, "ref", ids, "id").withColumn("ref", inject.next_existing("ref")())
    assert {tuple(r) for r in dirty.select("k", "ref").collect()} == {(1, -4), (2, 8), (3, None)}


def test_nested_evolution_both_ways(spark):
    from pyspark.sql import types as T

    from truegrain.sources import nested

    S, F_ = T.StructType, T.StructField
    item1 = S([F_("sku", T.StringType()), F_("qty", T.IntegerType()), F_("note", T.StringType())])
    v1 = S([F_("id", T.LongType(), False), F_("kind", T.StringType(), True, {"symbols": ["web", "shop", "fax"]}), F_("lines", T.ArrayType(item1)), F_("by.hand", S([F_("n", T.FloatType())])), F_("tags", T.MapType(T.StringType(), T.IntegerType()))])
    item2 = S([F_("qty", T.LongType()), F_("code", T.StringType(), True, {"aliases": ["ean", "sku"]}), F_("unit", T.StringType(), False, {"default": "pc"})])
    v2 = S([
        F_("id", T.LongType(), False), F_("kind", T.StringType(), True, {"symbols": ["web", "shop"], "symbol_default": "other"}), F_("items", T.ArrayType(item2), False, {"aliases": ["lines"], "default": [{"qty": 1, "code": "none", "unit": "pc"}]}),
        F_("by.hand", S([F_("n", T.DoubleType()), F_("why", T.StringType())])), F_("tags", T.MapType(T.StringType(), T.LongType())), F_("at", S([F_("city", T.StringType())]), True, {"default": {"city": "?"}}),
    ])
    assert nested.nested_problems(v1, v2) == []
    rows = spark.createDataFrame([(1, "fax", [("a", 2, "x"), None], (0.5,), {"k": 7, "l": None}), (2, None, None, None, None), (3, "web", [], (None,), {})], v1)
    assert [r.asDict(True) for r in nested.read_nested(rows, v1, v2).orderBy("id").collect()] == [
        {"id": 1, "kind": "other", "items": [{"qty": 2, "code": "a", "unit": "pc"}, None], "by.hand": {"n": 0.5, "why": None}, "tags": {"k": 7, "l": None}, "at": {"city": "?"}},
        {"id": 2, "kind": None, "items": [{"qty": 1, "code": "none", "unit": "pc"}], "by.hand": None, "tags": None, "at": {"city": "?"}},
        {"id": 3, "kind": "web", "items": [], "by.hand": {"n": None, "why": None}, "tags": {}, "at": {"city": "?"}},
    ]
    back = nested.nested_problems(v2, v1)
    assert [p.split(":")[0] for p in back] == ["by.hand.n", "tags{}"]
    assert any("fax" in p for p in nested.nested_problems(v1, S([F_("kind", T.StringType(), True, {"symbols": ["web", "shop"]})])))
    with pytest.raises(evolution.Incompatible, match="items\\[\\].qty"):
        nested.read_nested(rows, S([F_("items", T.ArrayType(S([F_("qty", T.StringType())])))]), v2)
    empty = nested.read_nested(rows.limit(0), v1, v2)
    assert empty.count() == 0 and empty.columns == v2.names
