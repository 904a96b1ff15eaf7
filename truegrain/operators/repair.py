"""Repairs as cell edits (row id, column, old, new, p, method): certain ones apply, others wait."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.functions.scalars import convert_unit
from truegrain.functions.similarity import indel_ratio
from truegrain.operators.agreement import most_probable, pair_rows, tuple_key
from truegrain.operators.aggregates import frequent_tuples
from truegrain.operators.diff import to_cells
from truegrain.operators.joins import lookup, map_values
from truegrain.operators.match import agreeing_tuples, nearest
from truegrain.operators.ranks import join_back
from truegrain.session import materialize

#: Pairs of tuples that `repair_by_frequency` scores as rows.
PAIRS = 50_000_000


def star(fact: DataFrame, dimensions: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Denormalise a fact with its dimensions; each is broadcast only if its counted size allows."""
    out = fact
    for dim, fk, pk in dimensions:
        out = out.join(dim, F.col(fk) == F.col(pk))
    return out


def as_edits(df: DataFrame, row_id: str, column: str, new: Column, method: str, p: Column | float = 1.0):
    """Cell edits for the rows whose new value differs from the old one."""
    changed = ~F.col(column).eqNullSafe(new)
    return df.filter(changed).select(
        F.col(row_id).cast("string").alias("row_id"),
        F.lit(column).alias("column"),
        F.col(column).cast("string").alias("old_value"),
        new.cast("string").alias("new_value"),
        (p if isinstance(p, Column) else F.lit(p)).alias("p"),
        F.lit(method).alias("method"),
    )


def repair_from_reference(df, reference, on: Column, row_id: str, column: str, reference_column: str):
    """Take the value of the reference table; without a match the old value stays."""
    joined = lookup(df, reference, on)
    return as_edits(joined, row_id, column, F.coalesce(reference_column, column), "reference")


def repair_by_mapping(df, row_id: str, column: str, mapping: dict[str, str]) -> DataFrame:
    known = df.filter(F.col(column).isin(list(mapping)))
    return as_edits(known, row_id, column, map_values(known, column, mapping), "mapping")


def repair_placeholder(df, row_id: str, column: str, values) -> DataFrame:
    bad = df.filter(F.col(column).isin(list(values)))
    return as_edits(bad, row_id, column, F.lit(None).cast("string"), "placeholder")


def repair_fuzzy(
    df: DataFrame, row_id: str, name: str, item_id: str, catalog: DataFrame, catalog_name: str,
    catalog_id: str, accept: float = 85.0, suggest: float | None = 60.0,
) -> DataFrame:
    """Suspects are rows whose name is not that of their id. `decision` is auto or review.

    Automatic only where the nearest name is the one of the row's own id at `accept` or better;
    items may share a name, of which `best_id` is the lowest.
    Reviews carry the nearest name at `suggest` or better, if there is one; for None, whatever its similarity.
    """
    own = catalog.select(F.col(catalog_id).alias("_own"), F.col(catalog_name).alias("_own_name"))
    suspects = df.join(own, F.col(item_id) == F.col("_own"), "left").filter(~F.col(name).eqNullSafe(F.col("_own_name")))
    best = nearest(suspects, name, catalog, catalog_name, catalog_id, suggest)
    joined = suspects.join(best, name, "left")
    auto = (F.col("best_name") == F.col("_own_name")) & (F.col("similarity") >= accept)
    return joined.select(
        F.col(row_id).cast("string").alias("row_id"),
        F.lit(name).alias("column"),
        F.col(name).alias("old_value"),
        F.col("best_name").alias("new_value"),
        "best_id",
        "similarity",
        F.when(F.coalesce(auto, F.lit(False)), "auto").otherwise("review").alias("decision"),
    )



def _by_pairs(rare: DataFrame, known: DataFrame, cols: list[str], similarity: dict, eps: float) -> DataFrame:
    """`most_probable` with a row for every pair of tuples; beyond PAIRS rows, as their square grows, without them."""
    if pair_rows(rare, known, cols) > PAIRS:
        return most_probable(rare, known, cols, similarity, eps, digits=15)
    pairs = agreeing_tuples(rare.select(*cols), known.select(*cols, "support"), cols, max_differences=2)
    logp = F.log(F.col("f_support").cast("double"))
    for c in cols:
        sim = F.lit(similarity[c])
        if similarity[c] is None:
            sim = F.greatest(indel_ratio(F.coalesce(c, F.lit("")), F.coalesce(f"f_{c}", F.lit(""))) / 100, F.lit(0.01))
        logp = logp + F.when(
            F.col(c).eqNullSafe(F.col(f"f_{c}")), F.lit(math.log(1 - eps))
        ).otherwise(F.log(F.lit(eps) * sim))
    scored = pairs.withColumn("logp", logp)
    target = F.struct(*[F.col(f"f_{c}").alias(c) for c in cols])
    best = scored.groupBy(*cols).agg(
        F.max("logp").alias("_top"),
        F.max_by(F.struct(target.alias("to"), "differs"), F.struct("logp", target.alias("t"))).alias("_best"),
    )
    total = (
        join_back(scored.select(*cols, "logp"), best.select(*cols, "_top"), cols)
        .groupBy(*cols)
        .agg(F.sum(F.exp(F.col("logp") - F.col("_top"))).alias("_z"))
    )
    out = join_back(best, total, cols)
    return out.select(tuple_key(cols).alias("_r"), F.col("_best.to").alias("_best"), (1 / F.col("_z")).alias("p"))


def repair_by_frequency(
    df: DataFrame, row_id: str, cols: list[str], min_support: int = 30, eps: float = 0.01,
    accept: float = 0.9, constant_similarity: float | None = None, pairs: bool = False,
) -> DataFrame:
    """Rare value combinations become the most probable frequent one at most two columns away.

    log p = log support + per column log(1 - eps) if equal, else log(eps * similarity); the best
    candidate carries its softmax probability. The similarity of ids is 0.05, that of other columns the
    one of their texts, or `constant_similarity` for all. `decision` is auto at p >= accept, else review.
    `pairs` scores every pair as a row of its own while they are at most PAIRS: the same result up to rounding.
    """
    text = df.select(F.col(row_id), *[F.col(c).cast("string").alias(c) for c in cols])
    counts = materialize(frequent_tuples(text, cols, min_support), "tuples")
    similarity = {c: constant_similarity or (0.05 if c.endswith("_id") else None) for c in cols}
    best = (_by_pairs if pairs else most_probable)(counts.filter(~F.col("frequent")), counts.filter("frequent"), cols, similarity, eps)
    rows = text.withColumn("_r", tuple_key(cols)).join(best, "_r")
    edits = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(c).alias("old_value"), F.col(f"_best.{c}").alias("new_value"))
                for c in cols
            ]
        )
    )
    return (
        rows.select(F.col(row_id).cast("string").alias("row_id"), "p", edits.alias("e"))
        .filter(~F.col("e.old_value").eqNullSafe(F.col("e.new_value")))
        .select(
            "row_id", "e.column", "e.old_value", "e.new_value", "p",
            F.when(F.col("p") >= accept, "auto").otherwise("review").alias("decision"),
        )
    )


def score_repairs(edits: DataFrame, clean: DataFrame, row_id: str, columns: list[str]) -> DataFrame:
    """Correct and wrong edits per column, compared as text with the clean table."""
    truth = to_cells(clean.withColumn("row_id", F.col(row_id).cast("string")), ["row_id"], columns)
    joined = edits.join(truth.withColumnRenamed("value", "truth"), ["row_id", "column"], "left")
    right = F.coalesce(F.col("new_value").eqNullSafe(F.col("truth")), F.lit(False))
    return joined.groupBy("column").agg(
        F.count(F.lit(1)).alias("edits"), F.count_if(right).alias("correct"), F.count_if(~right).alias("wrong")
    )


def apply_edits(df: DataFrame, edits: DataFrame, row_id: str, columns: list[str]) -> DataFrame:
    """Cell edits into the table: one row of edits per id, one join. An edit to NULL is kept."""
    wide = edits.groupBy("row_id").agg(
        *[
            F.max(F.when(F.col("column") == c, F.struct(F.lit(1).alias("x"), F.col("new_value").alias("v")))).alias(f"_e_{c}")
            for c in columns
        ]
    )
    joined = df.withColumn("_rid", F.col(row_id).cast("string")).join(
        wide.withColumnRenamed("row_id", "_rid"), "_rid", "left"
    )
    out = []
    for c in df.columns:
        if c in columns:
            kind = df.schema[c].dataType
            out.append(
                F.when(F.col(f"_e_{c}").isNotNull(), F.col(f"_e_{c}.v").try_cast(kind)).otherwise(F.col(c)).alias(c)
            )
        else:
            out.append(F.col(c))
    return joined.select(*out)


def repair_units(df: DataFrame, rules: list[tuple[str, Column, float, float]]) -> DataFrame:
    """Unit repairs before training: (column, condition, factor, offset) per rule, in one projection."""
    out = df
    for column, condition, factor, offset in rules:
        out = out.withColumn(column, convert_unit(column, condition, factor, offset))
    return out
