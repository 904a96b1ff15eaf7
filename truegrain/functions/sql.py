"""The scalar functions under SQL names. Their bodies are SQL, so Catalyst inlines them."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Name, signature, return type and body of each SQL function.
DEFINITIONS = {
    "pad_code": (
        "code STRING, width INT",
        "STRING",
        "CASE WHEN length(code) >= width THEN code ELSE lpad(code, width, '0') END",
    ),
    "signed_log1p": ("x DOUBLE", "DOUBLE", "signum(x) * ln(1 + abs(x))"),
    "strip_prefix_int": (
        "value STRING, prefix STRING",
        "BIGINT",
        "try_cast(regexp_extract(value, concat('^', prefix, '(-?[0-9]+)$'), 1) AS BIGINT)",
    ),
    "gtin13_valid": (
        "code STRING",
        "BOOLEAN",
        "coalesce(CASE WHEN code RLIKE '^[0-9]{13}$' THEN (10 - aggregate(sequence(1, 12), 0, (acc, i) -> acc"
        " + CAST(substr(code, i, 1) AS INT) * CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END) % 10) % 10"
        " = CAST(substr(code, 13, 1) AS INT) END, false)",
    ),
}


def register(spark: SparkSession, names: list[str] | None = None) -> None:
    for name in names or DEFINITIONS:
        signature, returns, body = DEFINITIONS[name]
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({signature}) RETURNS {returns} RETURN {body}")
