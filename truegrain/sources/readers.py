"""Readers: typed tables, text tables, rejects, table variants and event streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.functions.scalars import NULL_TOKENS, ambiguous_date, normalize_null, number_format, parse_mixed_dates
from truegrain.session import materialize

FORMATS = {"parquet": "parquet", "csv": "csv", "json": "json", "jsonl": "json", "orc": "orc"}


def read_table(
    spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | str | None = None, view: str | None = None
) -> DataFrame:
    """A file or folder by its extension, with a declared schema, and as a view if named."""
    fmt = fmt or FORMATS[path.rstrip("/").rsplit(".", 1)[-1].lower()]
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    df = reader.load(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


class TableRegistry:
    """Tables of one variant (clean, dirty, drift ...): <root>/<variant>/<name>.parquet, else .csv."""

    def __init__(self, spark: SparkSession, root: str, variant: str, schemas: dict | None = None):
        self.spark, self.root, self.variant = spark, root.rstrip("/"), variant
        self.schemas = schemas or {}

    def path(self, name: str) -> str:
        for extension in ("parquet", "csv"):
            path = f"{self.root}/{self.variant}/{name}.{extension}"
            if path_exists(self.spark, path):
                return path
        raise FileNotFoundError(f"{self.root}/{self.variant}/{name}")

    def load(self, name: str, view: bool = False) -> DataFrame:
        label = f"{self.variant}_{name}" if view else None
        return read_table(self.spark, self.path(name), schema=self.schemas.get(name), view=label)


def read_all_text(spark: SparkSession, path: str, columns: list[str], null_tokens=("",)) -> DataFrame:
    """Every column as text; only the named tokens become NULL."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.schema(schema).option("header", "true").option("nullValue", "\u0000").option("emptyValue", "").csv(path)
    return df.select(*[F.when(~F.col(c).isin(list(null_tokens)), F.col(c)).alias(c) for c in columns])


def read_csv_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines). A row with an extra or unparsable cell is kept as its raw line.

    The parsed rows are written once: Spark refuses queries that need the corrupt line alone, and
    both halves come from one parse.
    """
    fields = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    full = T.StructType([*fields.fields, T.StructField("_line", T.StringType())])
    rows = materialize(
        spark.read.schema(full)
        .option("header", str(header).lower())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_line")
        .csv(path),
        "parsed",
    )
    return rows.filter(F.col("_line").isNull()).drop("_line"), rows.filter(F.col("_line").isNotNull())


def normalize_nulls(df: DataFrame, tokens=NULL_TOKENS, columns: list[str] | None = None) -> DataFrame:
    chosen = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.select(*[normalize_null(c, tokens).alias(c) if c in chosen else F.col(c) for c in df.columns])


def clean_exchange(df: DataFrame, dates: list[str], numbers: list[str]) -> DataFrame:
    """Exchange file columns: parsed dates with an ambiguity flag, numbers with their format class."""
    out = df
    for c in dates:
        out = out.withColumn(f"{c}_day", parse_mixed_dates(c)).withColumn(f"{c}_ambiguous", ambiguous_date(c))
    for c in numbers:
        out = out.withColumn(f"{c}_format", number_format(c)).withColumn(
            f"{c}_number", F.replace(F.trim(c), F.lit(","), F.lit(".")).try_cast("double")
        )
    return out


def read_events(spark: SparkSession, path: str, schema, fmt: str = "parquet", glob: str | None = None, per_trigger: int | None = None):
    """Event stream from a folder of files; other formats (e.g. kafka) by their own options."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path)
