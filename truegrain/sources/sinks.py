"""Writers: quarantine, alerts, rounded exports and a comparison of file formats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.operators.validate import flag_rows, reason_text
from truegrain.session import materialize, scratch_path


def write_quarantine(df: DataFrame, contract, good_path: str, bad_path: str, parents=None, fmt: str = "csv") -> tuple[int, int]:
    """Good rows to Parquet, bad rows with `error` and `reason` to CSV, from one evaluation."""
    flagged = materialize(flag_rows(df, contract, parents), "split")
    good = flagged.filter(F.size("failures") == 0).drop("failures")
    bad = flagged.filter(F.size("failures") > 0).select(
        *df.columns, F.element_at("failures", 1)["kind"].alias("error"), reason_text().alias("reason")
    )
    good.write.mode("overwrite").parquet(good_path)
    writer = bad.write.mode("overwrite").format(fmt)
    (writer.option("header", "true") if fmt == "csv" else writer).save(bad_path)
    counts = flagged.agg(
        F.count_if(F.size("failures") == 0).alias("good"), F.count_if(F.size("failures") > 0).alias("bad")
    ).first()
    return counts["good"], counts["bad"]


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Floating-point columns rounded, everything else as it is."""
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def export_rounded_csv(df: DataFrame, path: str, digits: int = 4) -> None:
    rounded(df, digits).write.mode("overwrite").option("header", "true").csv(path)


def date_column(df: DataFrame) -> str:
    """The first date or timestamp column."""
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return f.name
    raise ValueError("no date column")


def preview_extract(df: DataFrame, start: str, end: str, date: str | None = None, **equal) -> DataFrame:
    """The rows of some days and keys: plain comparisons that reach the file scan."""
    date = date or date_column(df)
    kind = df.schema[date].dataType.simpleString()
    until = F.date_add(F.to_date(F.lit(end)), 1).cast(kind)
    out = df.filter((F.col(date) >= F.lit(start).cast(kind)) & (F.col(date) < until))
    for k, v in equal.items():
        out = out.filter(F.col(k) == v)
    return out


def folder_bytes(spark, path: str) -> int:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(hadoop).getLength()


def format_roundtrip_report(df: DataFrame, formats=("csv", "json", "parquet", "orc"), folder: str | None = None) -> DataFrame:
    """(format, bytes, column_name, type_before, type_after, kept) after writing and reading back."""
    import time

    spark = df.sparkSession
    folder = folder or scratch_path(spark, "formats")
    rows = []
    for fmt in formats:
        path = f"{folder}/{fmt}"
        writer, reader = df.write.format(fmt), spark.read.format(fmt)
        if fmt == "csv":
            writer, reader = writer.option("header", "true"), reader.option("header", "true").option("inferSchema", "true")
        start = time.time()
        writer.save(path)
        wrote = time.time() - start
        after = {f.name: f.dataType.simpleString() for f in reader.load(path).schema.fields}
        size = folder_bytes(spark, path)
        for f in df.schema.fields:
            before = f.dataType.simpleString()
            rows.append((fmt, size, round(wrote, 3), f.name, before, after.get(f.name), before == after.get(f.name)))
    return spark.createDataFrame(
        rows, "format string, bytes bigint, write_seconds double, column_name string, type_before string, type_after string, kept boolean"
    )
