"""Scorecards: checks as data, measured with one aggregate per table and pivoted by dimension."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.operators.aggregates import uniqueness
from truegrain.operators.diff import union_all

# The quality dimensions of a scorecard.
DIMENSIONS = ["validity", "completeness", "uniqueness", "consistency", "timeliness", "accuracy"]


@dataclass(frozen=True)
class Check:
    """A share of good records: a `measure` over one table, or a one-row frame with `score`.

    Measures of one table run in one aggregate. Distinct counts and joins are frames of their own,
    so that they do not multiply the rows of the cheap measures.
    """

    table: str
    dimension: str
    name: str
    measure: Callable[[], Column] | None = None
    frame: Callable[[dict[str, DataFrame]], DataFrame] | None = None


def distinct_check(table: str, name: str, *cols: str) -> Check:
    """Distinct values of the columns per row."""
    return Check(table, "uniqueness", name, frame=lambda t: t[table].agg(uniqueness(*cols).alias("score")))


def measure_checks(tables: dict[str, DataFrame], checks: list[Check], origins: dict[str, str]) -> DataFrame:
    """(source, origin, dimension, check_name, score) for every check; `origins` tells how a table comes in."""

    def labels(c: Check) -> list[Column]:
        values = {"source": c.table, "origin": origins[c.table], "dimension": c.dimension, "check_name": c.name}
        return [F.lit(v).alias(k) for k, v in values.items()]

    parts, fused = [], {}
    for c in checks:
        if c.frame is None:
            fused.setdefault(c.table, []).append(c)
        else:
            parts.append(c.frame(tables).select(*labels(c), F.col("score").cast("double").alias("score")))
    for table, group in fused.items():
        row = tables[table].agg(*[c.measure().cast("double").alias(f"m{i}") for i, c in enumerate(group)])
        cells = [F.struct(*labels(c), F.col(f"m{i}").alias("score")) for i, c in enumerate(group)]
        parts.append(row.select(F.inline(F.array(*cells))))
    return union_all(*parts)


def scorecard(scores: DataFrame, dimensions: list[str] = DIMENSIONS) -> DataFrame:
    """Worst score per source and dimension."""
    return scores.groupBy("source", "origin").pivot("dimension", dimensions).agg(F.min("score"))
