"""Approximate functional dependencies: confidence, mining and the rows that break them."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.operators.aggregates import group_mode
from truegrain.operators.ranks import join_back


def confidence(df: DataFrame, lhs: str, rhs: str) -> DataFrame:
    """Share of rows whose rhs is the most frequent one of their lhs."""
    counts = df.groupBy(lhs, rhs).agg(F.count(F.lit(1)).alias("n"))
    tops = counts.groupBy(lhs).agg(F.max("n").alias("top"), F.sum("n").alias("rows"))
    return tops.agg((F.sum("top") / F.sum("rows")).alias("confidence"))


def mine(
    df: DataFrame,
    columns: list[str],
    minimum: float = 0.95,
    excluded_rhs: tuple[str, ...] = (),
    keep_exact: bool = False,
) -> DataFrame:
    """All ordered column pairs with minimum <= confidence < 1, best first.

    Rows are reduced to distinct tuples before the column pairs multiply them, each unordered pair
    is counted once, and both directions come from the same counts.
    """
    as_text = [F.col(c).cast("string").alias(c) for c in columns]
    tuples = df.select(*as_text).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    pairs = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("av"), F.col(b).alias("bv")
                )
                for a, b in combinations(columns, 2)
            ]
        )
    )
    counts = (
        tuples.select("n", pairs.alias("p"))
        .groupBy("p.a", "p.b", "p.av", "p.bv")
        .agg(F.sum("n").alias("n"))
    )
    both = counts.select(
        "n",
        F.explode(
            F.array(
                F.struct(F.col("a").alias("lhs"), F.col("b").alias("rhs"), F.col("av").alias("lv")),
                F.struct(F.col("b").alias("lhs"), F.col("a").alias("rhs"), F.col("bv").alias("lv")),
            )
        ).alias("d"),
    )
    tops = both.groupBy("d.lhs", "d.rhs", "d.lv").agg(
        F.max("n").alias("top"), F.sum("n").alias("rows")
    )
    values = tops.groupBy("lhs", "rhs").agg(
        (F.sum("top") / F.sum("rows")).alias("confidence"),
        F.count("lv").alias("lhs_values"),
    )
    # the number of distinct rhs values is the number of lhs values of the mirrored pair
    mirror = values.select(
        F.col("lhs").alias("rhs"), F.col("rhs").alias("lhs"), F.col("lhs_values").alias("rhs_values")
    )
    upper = F.lit(True) if keep_exact else F.col("confidence") < 1
    return (
        values.join(mirror, ["lhs", "rhs"])
        .filter((F.col("lhs_values") > 1) & (F.col("rhs_values") > 1))
        .filter((F.col("confidence") >= minimum) & upper & ~F.col("rhs").isin(list(excluded_rhs)))
        .select("lhs", "rhs", "confidence")
        .orderBy(F.desc("confidence"), "lhs", "rhs")
    )


def violations(df: DataFrame, lhs: str, rhs: str, row_id: list[str]) -> DataFrame:
    """Rows whose rhs is not the usual value for their lhs."""
    usual = group_mode(df, [lhs], rhs, "usual")
    return join_back(df, usual, [lhs]).filter(F.col(rhs) != F.col("usual")).select(*row_id, lhs, rhs, "usual")
