"""Expectation suites: all row-level expectations of a table in one aggregate, with examples."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truegrain.functions.predicates import type_is
from truegrain.operators.diff import union_all
from truegrain.operators.ranks import quantiles
from truegrain.operators.windows import duplicate_member_count, duplicate_members

RESULT = ["expectation", "column_name", "success", "unexpected", "observed"]


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str
    options: dict = field(default_factory=dict)

    @property
    def label(self) -> str:
        return f"{self.kind} {self.column}"


def between(column, lo=None, hi=None) -> Expectation:
    return Expectation("between", column, {"lo": lo, "hi": hi})


def in_set(column, values) -> Expectation:
    return Expectation("in set", column, {"values": list(values)})


def in_table(column, parent: DataFrame, parent_column: str) -> Expectation:
    return Expectation("in table", column, {"parent": parent, "parent_column": parent_column})


def not_before(column, other) -> Expectation:
    """column >= other."""
    return Expectation("not before", column, {"other": other})


def unique(*columns) -> Expectation:
    return Expectation("unique", ",".join(columns), {"columns": list(columns)})


def of_type(column, type_name) -> Expectation:
    return Expectation("type", column, {"type": type_name})


def median_between(column, lo, hi) -> Expectation:
    return Expectation("median", column, {"lo": lo, "hi": hi})


def stdev_at_most(column, limit) -> Expectation:
    return Expectation("stdev", column, {"limit": limit})


def max_at_most(column, limit) -> Expectation:
    return Expectation("max", column, {"limit": limit})


def _bad(e: Expectation) -> Column | None:
    """Row-level violation; NULL values are left alone."""
    c, o = F.col(e.column.split(",")[0]), e.options
    if e.kind == "between":
        bad = F.lit(False)
        if o["lo"] is not None:
            bad = bad | (c < F.lit(o["lo"]))
        if o["hi"] is not None:
            bad = bad | (c > F.lit(o["hi"]))
        return bad
    if e.kind == "in set":
        return ~c.isin(o["values"])
    if e.kind == "not before":
        return c < F.col(o["other"])
    return None


def _row(e: Expectation, success: Column, unexpected: Column, observed: Column) -> list[Column]:
    return [
        F.lit(e.kind).alias("expectation"),
        F.lit(e.column).alias("column_name"),
        F.coalesce(success, F.lit(False)).alias("success"),
        unexpected.cast("bigint").alias("unexpected"),
        F.round(observed.cast("double"), 6).alias("observed"),
    ]


def expect(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """(expectation, column_name, success, unexpected, observed), one row per expectation."""
    nothing = F.lit(None)
    fused, parts = [], []
    for e in suite:
        if _bad(e) is not None or e.kind in ("stdev", "max", "type"):
            fused.append(e)
        elif e.kind == "unique":
            counted = duplicate_member_count(df, e.options["columns"])
            parts.append(counted.select(*_row(e, F.col("unexpected") == 0, F.col("unexpected"), nothing)))
        elif e.kind == "in table":
            parent = e.options["parent"].select(F.col(e.options["parent_column"]).alias("_pk")).distinct()
            missing = df.filter(F.col(e.column).isNotNull()).join(
                parent, F.col(e.column) == F.col("_pk"), "left_anti"
            ).agg(F.count(F.lit(1)).alias("unexpected"))
            parts.append(missing.select(*_row(e, F.col("unexpected") == 0, F.col("unexpected"), nothing)))
        elif e.kind == "median":
            m = quantiles(df, [], e.column, {"m": 0.5})
            inside = F.col("m").between(e.options["lo"], e.options["hi"])
            parts.append(m.select(*_row(e, inside, nothing, F.col("m"))))
    if fused:
        aggs = []
        for i, e in enumerate(fused):
            if _bad(e) is not None:
                aggs.append(F.count_if(_bad(e)).alias(f"a{i}"))
            elif e.kind == "stdev":
                aggs.append(F.stddev_samp(e.column).alias(f"a{i}"))
            elif e.kind == "max":
                aggs.append(F.max(e.column).cast("double").alias(f"a{i}"))
            else:
                aggs.append(F.lit(type_is(df, e.column, e.options["type"])).alias(f"a{i}"))
        rows = []
        for i, e in enumerate(fused):
            a = F.col(f"a{i}")
            if _bad(e) is not None:
                cells = _row(e, a == 0, a, nothing)
            elif e.kind == "type":
                cells = _row(e, a, nothing, nothing)
            else:
                cells = _row(e, a <= e.options["limit"], nothing, a)
            rows.append(F.struct(*cells))
        parts.append(df.agg(*aggs).select(F.inline(F.array(*rows))))
    return union_all(*parts)


def unexpected_examples(df: DataFrame, suite: list[Expectation], n: int = 3) -> DataFrame:
    """The n smallest distinct offending values per expectation; n per task cross the shuffle."""
    cells = [
        F.when(
            _bad(e),
            F.struct(
                F.lit(e.kind).alias("expectation"),
                F.lit(e.column).alias("column_name"),
                F.col(e.column).cast("string").alias("example"),
            ),
        )
        for e in suite
        if _bad(e) is not None
    ]
    parts = [df.select(F.inline(F.array_compact(F.array(*cells))))] if cells else []
    for e in suite:
        if e.kind == "unique":
            cols = e.options["columns"]
            groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
            parts.append(
                groups.select(
                    F.lit(e.kind).alias("expectation"),
                    F.lit(e.column).alias("column_name"),
                    F.concat_ws("|", *[F.col(c).cast("string") for c in cols]).alias("example"),
                )
            )
        elif e.kind == "in table":
            missing = unexpected_rows(df, e).select(F.col(e.column).cast("string").alias("example"))
            parts.append(missing.select(F.lit(e.kind).alias("expectation"), F.lit(e.column).alias("column_name"), "example"))
    keys = ["expectation", "column_name"]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("example"))
    return (
        union_all(*parts).distinct().withColumn("place", place).filter(F.col("place") <= n)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("example")).alias("examples"))
    )


def unexpected_rows(df: DataFrame, e: Expectation) -> DataFrame:
    """The rows behind one expectation."""
    if e.kind == "unique":
        return duplicate_members(df, e.options["columns"])
    if e.kind == "in table":
        parent = e.options["parent"].select(F.col(e.options["parent_column"]).alias("_pk")).distinct()
        return df.filter(F.col(e.column).isNotNull()).join(parent, F.col(e.column) == F.col("_pk"), "left_anti")
    return df.filter(_bad(e))


# Legal units of a delivery.
UNITS = ("count", "kg", "liter")


def delivery_suite(suppliers: DataFrame, products: DataFrame, start: str, end: str) -> list[Expectation]:
    """Fourteen expectations on a monthly batch of deliveries."""
    return [
        of_type("delivery_id", "bigint"),
        unique("delivery_id"),
        of_type("quantity", "double"),
        between("quantity", 0),
        in_set("unit", UNITS),
        of_type("supplier_id", "bigint"),
        in_table("supplier_id", suppliers, "id"),
        in_table("category", products, "category"),
        between("delivery_date", start, end),
        not_before("entered_at", "received_at"),
        unique("delivery_date", "store_id", "product_id", "quantity"),
        median_between("quantity", 10, 60),
        stdev_at_most("quantity", 200),
        max_at_most("quantity", 2000),
    ]
