"""Table contracts: what a table promises, as data. Loaders build them from several notations."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_DEFAULT = object()


@dataclass(frozen=True)
class FieldRule:
    name: str
    type: str = "string"
    required: bool = False
    minimum: Any = None
    maximum: Any = None
    above: Any = None
    below: Any = None
    allowed: tuple | None = None
    pattern: str | None = None
    min_length: int | None = None
    max_length: int | None = None
    unique: bool = False
    default: Any = NO_DEFAULT
    checks: tuple[tuple[str, Callable[[Column], Column]], ...] = ()


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableContract:
    name: str
    fields: tuple[FieldRule, ...]
    unique_keys: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    row_checks: tuple[tuple[str, Callable[[], Column]], ...] = ()
    allow_extra: bool = True

    def field(self, name: str) -> FieldRule:
        return next(f for f in self.fields if f.name == name)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def keys(self) -> list[tuple[str, ...]]:
        return [(f.name,) for f in self.fields if f.unique] + list(self.unique_keys)

    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(f.name, T._parse_datatype_string(f.type), not f.required)
                for f in self.fields
            ]
        )


# Type names of the table-schema and JSON-schema notations and their Spark types.
TYPE_NAMES = {
    "integer": "bigint",
    "number": "double",
    "string": "string",
    "boolean": "boolean",
    "date": "date",
    "datetime": "timestamp",
}


def from_dict(spec: dict) -> TableContract:
    """{'name', 'fields': {column: {type, required, minimum, ...}}, 'unique', 'foreign_keys'}"""
    fields = []
    for name, rules in spec["fields"].items():
        options = dict(rules)
        if "allowed" in options:
            options["allowed"] = tuple(options["allowed"])
        fields.append(FieldRule(name, **options))
    return TableContract(
        spec["name"],
        tuple(fields),
        tuple(tuple(k) for k in spec.get("unique", ())),
        tuple(ForeignKey(*k) for k in spec.get("foreign_keys", ())),
        tuple(spec.get("row_checks", ())),
        spec.get("allow_extra", True),
    )


def from_table_schema(name: str, schema: dict) -> TableContract:
    """A tabular package schema: fields with constraints, primaryKey, foreignKeys."""
    fields = []
    for f in schema["fields"]:
        c = f.get("constraints", {})
        fields.append(
            FieldRule(
                f["name"],
                TYPE_NAMES[f.get("type", "string")],
                required=c.get("required", False),
                minimum=c.get("minimum"),
                maximum=c.get("maximum"),
                allowed=tuple(c["enum"]) if "enum" in c else None,
                pattern=c.get("pattern"),
                min_length=c.get("minLength"),
                max_length=c.get("maxLength"),
            )
        )
    primary = schema.get("primaryKey", [])
    primary = [primary] if isinstance(primary, str) else primary
    return TableContract(
        name,
        tuple(replace(f, required=f.required or f.name in primary) for f in fields),
        (tuple(primary),) if primary else (),
        tuple(
            ForeignKey(k["fields"][0], k["reference"]["resource"], k["reference"]["fields"][0])
            for k in schema.get("foreignKeys", [])
        ),
        allow_extra=False,
    )


def from_package_yaml(text: str) -> dict[str, TableContract]:
    import yaml

    package = yaml.safe_load(text)
    return {r["name"]: from_table_schema(r["name"], r["schema"]) for r in package["resources"]}


def from_json_schema(name: str, schema: dict | str) -> TableContract:
    """A flat object schema; nested objects are checked by truegrain.operators.documents."""
    spec = json.loads(schema) if isinstance(schema, str) else schema
    required = set(spec.get("required", ()))
    fields = []
    for column, p in spec["properties"].items():
        fields.append(
            FieldRule(
                column,
                TYPE_NAMES[p.get("type", "string")],
                required=column in required,
                minimum=p.get("minimum"),
                maximum=p.get("maximum"),
                above=p.get("exclusiveMinimum"),
                below=p.get("exclusiveMaximum"),
                allowed=tuple(p["enum"]) if "enum" in p else None,
                pattern=p.get("pattern"),
                min_length=p.get("minLength"),
                max_length=p.get("maxLength"),
            )
        )
    return TableContract(name, tuple(fields), allow_extra=spec.get("additionalProperties", True))


def learn(df: DataFrame, name: str = "learned", max_categories: int = 20) -> TableContract:
    """Contract of a good batch: types, number and date ranges, closed sets of few-valued text.

    One aggregate over the batch gives bounds and NULL counts; the sets come from distinct values
    that are cut at max_categories + 1 per column, so nothing unbounded reaches the driver.
    """
    aggs, text = [], []
    for f in df.schema.fields:
        aggs.append(F.count_if(F.col(f.name).isNull()).alias(f"null|{f.name}"))
        if isinstance(f.dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            aggs += [F.min(f.name).alias(f"min|{f.name}"), F.max(f.name).alias(f"max|{f.name}")]
        elif isinstance(f.dataType, T.StringType):
            text.append(f.name)
    stats = df.agg(*aggs).first().asDict()
    fields = []
    for f in df.schema.fields:
        allowed = None
        if f.name in text:
            values = [
                r[0]
                for r in df.select(f.name).filter(F.col(f.name).isNotNull()).distinct()
                .limit(max_categories + 1).collect()
            ]
            if len(values) <= max_categories:
                allowed = tuple(sorted(values))
        fields.append(
            FieldRule(
                f.name,
                f.dataType.simpleString(),
                required=stats[f"null|{f.name}"] == 0,
                minimum=stats.get(f"min|{f.name}"),
                maximum=stats.get(f"max|{f.name}"),
                allowed=allowed,
            )
        )
    return TableContract(name, tuple(fields))
