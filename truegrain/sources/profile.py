"""What a type guesser would see in text columns, in one pass over the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Candidate types, most specific first.
CANDIDATES = ("boolean", "bigint", "double", "date", "timestamp")


def type_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, rows, nulls, blanks, boolean, bigint, double, date, timestamp, inferred).

    A type is inferred when every non-NULL, non-blank value casts to it; one bad value makes the
    column text.
    """
    columns = columns or df.columns
    aggs = []
    for c in columns:
        text = F.col(f"`{c}`").cast("string")
        filled = text.isNotNull() & (F.trim(text) != "")
        aggs += [
            F.count(F.lit(1)).alias(f"rows|{c}"),
            F.count_if(text.isNull()).alias(f"nulls|{c}"),
            F.count_if(F.trim(text) == "").alias(f"blanks|{c}"),
            *[F.count_if(filled & text.try_cast(t).isNotNull()).alias(f"{t}|{c}") for t in CANDIDATES],
        ]
    measures = ["rows", "nulls", "blanks", *CANDIDATES]
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{m}|{c}`").alias(m) for m in measures])
            for c in columns
        ]
    )
    long = df.agg(*aggs).select(F.inline(rows))
    filled = F.col("rows") - F.col("nulls") - F.col("blanks")
    inferred = F.when(filled == 0, "void")
    for t in CANDIDATES:
        inferred = inferred.when(F.col(t) == filled, t)
    return long.withColumn("inferred", inferred.otherwise("string"))
