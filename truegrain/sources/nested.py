"""Schema evolution of nested data: structs, arrays, maps and enums, resolved by name at any depth.

Schemas are Spark types. Metadata of a reader's field may hold `aliases` (names a writer may have used),
`default` (stands in for a field that was not written, and for NULL where the reader has no place for it),
`symbols` (the texts an enum may take; a writer's field may hold them too) and `symbol_default` (for texts the reader
does not know). Resolution happens once on the schemas; the data see one projection.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.sources.evolution import WIDENS, Incompatible

NESTED = (T.StructType, T.ArrayType, T.MapType)


def written_field(writer: T.StructType, field: T.StructField) -> T.StructField | None:
    """The writer's field of the reader's name, else of its first alias that was written."""
    known = {f.name: f for f in writer.fields}
    return next((known[n] for n in (field.name, *field.metadata.get("aliases", ())) if n in known), None)


def _field_problems(written: T.StructField | None, field: T.StructField, at: str) -> list[str]:
    has_default = "default" in field.metadata
    if written is None:
        return [] if field.nullable or has_default else [f"{at}: not written and without a default"]
    problems = _type_problems(written.dataType, field.dataType, at)
    if written.nullable and not field.nullable and not has_default:
        problems.append(f"{at}: may be missing, but the reader needs it")
    symbols = field.metadata.get("symbols")
    if symbols and "symbol_default" not in field.metadata:
        unknown = sorted(set(written.metadata.get("symbols", ())) - set(symbols))
        if unknown:
            problems.append(f"{at}: the reader does not know {unknown}")
        elif "symbols" not in written.metadata:
            problems.append(f"{at}: any text may have been written, the reader knows {sorted(symbols)} only")
    return problems


def _type_problems(writer: T.DataType, reader: T.DataType, at: str) -> list[str]:
    if isinstance(reader, NESTED) or isinstance(writer, NESTED):
        if type(writer) is not type(reader):
            return [f"{at}: {writer.simpleString()} cannot be read as {reader.simpleString()}"]
    if isinstance(reader, T.StructType):
        return [p for f in reader.fields for p in _field_problems(written_field(writer, f), f, f"{at}.{f.name}" if at else f.name)]
    if isinstance(reader, T.ArrayType):
        missing = [f"{at}[]: may be missing, but the reader needs it"] if writer.containsNull and not reader.containsNull else []
        return _type_problems(writer.elementType, reader.elementType, f"{at}[]") + missing
    if isinstance(reader, T.MapType):
        missing = [f"{at}{{}}: may be missing, but the reader needs it"] if writer.valueContainsNull and not reader.valueContainsNull else []
        keys = [] if writer.keyType == reader.keyType else [f"{at}: keys of {writer.keyType.simpleString()} cannot be read as {reader.keyType.simpleString()}"]
        return keys + _type_problems(writer.valueType, reader.valueType, f"{at}{{}}") + missing
    if writer != reader and reader.simpleString() not in WIDENS.get(writer.simpleString(), set()):
        return [f"{at}: {writer.simpleString()} cannot be read as {reader.simpleString()}"]
    return []


def nested_problems(writer: T.StructType, reader: T.StructType) -> list[str]:
    """Why the reader cannot read what the writer wrote, with the path of each field; empty when it can."""
    return _type_problems(writer, reader, "")


def _changes(writer: T.DataType, reader: T.DataType) -> bool:
    """Whether values must be rebuilt; equal types without enums are taken as they are."""
    if isinstance(reader, T.StructType):
        same = [f.name for f in writer.fields] == [f.name for f in reader.fields]
        return not same or any("symbols" in r.metadata or w.nullable and not r.nullable or _changes(w.dataType, r.dataType) for w, r in zip(writer.fields, reader.fields, strict=True))
    if isinstance(reader, T.ArrayType):
        return _changes(writer.elementType, reader.elementType)
    if isinstance(reader, T.MapType):
        return _changes(writer.valueType, reader.valueType)
    return writer != reader


def _default(field: T.StructField) -> Column:
    value = field.metadata.get("default")
    if value is not None and isinstance(field.dataType, NESTED):
        # from_json takes structs, arrays and maps alike
        return F.from_json(F.lit(json.dumps(value)), field.dataType)
    return F.lit(value).cast(field.dataType)


def _value(value: Column, writer: T.DataType, reader: T.DataType) -> Column:
    if not _changes(writer, reader):
        return value
    if isinstance(reader, T.StructType):
        return F.when(value.isNotNull(), F.struct(*_fields(writer, reader, value.getField)))
    if isinstance(reader, T.ArrayType):
        return F.transform(value, lambda x: _value(x, writer.elementType, reader.elementType))
    if isinstance(reader, T.MapType):
        return F.transform_values(value, lambda _, x: _value(x, writer.valueType, reader.valueType))
    return value.cast(reader)


def _fields(writer: T.StructType, reader: T.StructType, get) -> list[Column]:
    out = []
    for field in reader.fields:
        written = written_field(writer, field)
        if written is None:
            value = _default(field)
        else:
            value = _value(get(written.name), written.dataType, field.dataType)
            if "symbols" in field.metadata and "symbol_default" in field.metadata:
                known = value.isin(field.metadata["symbols"])
                value = F.when(value.isNull() | known, value).otherwise(F.lit(field.metadata["symbol_default"]))
            if not field.nullable and "default" in field.metadata:
                value = F.coalesce(value, _default(field))
        out.append(value.alias(field.name))
    return out


def read_nested(df: DataFrame, writer: T.StructType, reader: T.StructType) -> DataFrame:
    """Data of the writer as the reader wants it, at any depth.

    Fields are found by name or alias, fields the reader does not have are skipped, and never read from
    columnar files. A NULL struct, array or map stays one unless the reader's default fills it; so does NULL in an
    enum. Raises Incompatible where the schemas do not resolve.
    """
    problems = nested_problems(writer, reader)
    if problems:
        raise Incompatible("; ".join(problems))
    return df.select(*_fields(writer, reader, lambda name: F.col(f"`{name}`")))
