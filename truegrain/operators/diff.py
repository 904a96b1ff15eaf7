"""Differences of two versions of a table, unions and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_cells(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Long form (keys, column, value as text)."""
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                for c in columns
            ]
        )
    )
    return df.select(*keys, cells.alias("cell")).select(*keys, "cell.column", "cell.value")


def _same(old, new):
    numeric = old.try_cast("double") == new.try_cast("double")
    blank = lambda c: F.coalesce(c, F.lit(""))
    return F.coalesce(numeric, F.lit(False)) | (blank(old) == blank(new))


def cell_diff(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Changed cells of the rows both versions have; equal numbers and NULL vs '' do not count.

    One join on the key, then only the changed cells become rows.
    """
    left = old.select(*keys, *[F.col(c).cast("string").alias(f"_old_{c}") for c in columns])
    right = new.select(*keys, *[F.col(c).cast("string").alias(f"_new_{c}") for c in columns])
    changed = F.array_compact(
        F.array(
            *[
                F.when(
                    ~_same(F.col(f"_old_{c}"), F.col(f"_new_{c}")),
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"_old_{c}").alias("old_value"),
                        F.col(f"_new_{c}").alias("new_value"),
                    ),
                )
                for c in columns
            ]
        )
    )
    return (
        left.join(right, keys)
        .select(*keys, F.explode(changed).alias("c"))
        .select(*keys, "c.column", "c.old_value", "c.new_value")
    )


def row_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that were added or removed, from one full join of the distinct keys."""
    a = old.select(*keys).distinct().withColumn("_old", F.lit(1))
    b = new.select(*keys).distinct().withColumn("_new", F.lit(1))
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed")
    return (
        a.join(b, keys, "full")
        .withColumn("change", change)
        .filter(F.col("change").isNotNull())
        .select(*keys, "change")
    )


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def append_rows(df: DataFrame, extra: DataFrame) -> DataFrame:
    """Append rows that may lack some columns."""
    return df.unionByName(extra, allowMissingColumns=True)


def split_by_cause(found: DataFrame, key: str, causes: list[tuple[str, DataFrame]], rest: str):
    """Give each found id its first matching cause, in the order of the list."""
    out = found.select(key).distinct()
    label = None
    for name, ids in causes:
        flag = f"_is_{name}"
        out = out.join(ids.select(key).distinct().withColumn(flag, F.lit(True)), key, "left")
        hit = F.col(flag).isNotNull()
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return out.select(key, label.otherwise(rest).alias("cause"))


def melt(df: DataFrame, ids: list[str], values: list[str], name: str = "metric", value: str = "value"):
    return df.unpivot(ids, values, name, value)


def spread(df: DataFrame, ids: list[str], name: str, value: str, labels: list[str]) -> DataFrame:
    return df.groupBy(*ids).pivot(name, labels).agg(F.first(value))
