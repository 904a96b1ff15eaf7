"""Schema evolution between writer and reader contracts: match by name, defaults, safe widening."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.plans.contract import NO_DEFAULT, FieldRule, TableContract

# The widenings of schema resolution, as writer type -> reader types. Large whole numbers may round as float or double.
WIDENS = {
    "int": {"bigint", "float", "double"},
    "bigint": {"float", "double"},
    "float": {"double"},
    "date": {"timestamp"},
}


class Incompatible(ValueError):
    """The reader cannot use what the writer wrote."""


def _readable(writer: FieldRule, reader: FieldRule) -> str | None:
    if writer.type != reader.type and reader.type not in WIDENS.get(writer.type, set()):
        return f"{reader.name}: {writer.type} cannot be read as {reader.type}"
    if not writer.required and reader.required and reader.default is NO_DEFAULT and writer.default is NO_DEFAULT:
        return f"{reader.name}: may be missing, but the reader needs it"
    if writer.allowed and reader.allowed and not set(writer.allowed) <= set(reader.allowed):
        return f"{reader.name}: the reader does not know {sorted(set(writer.allowed) - set(reader.allowed))}"
    return None


def reading_problems(writer: TableContract, reader: TableContract) -> list[str]:
    """Why the reader cannot read data of the writer; empty when it can."""
    known = {f.name: f for f in writer.fields}
    problems = []
    for f in reader.fields:
        if f.name in known:
            problem = _readable(known[f.name], f)
            if problem:
                problems.append(problem)
        elif f.required and f.default is NO_DEFAULT:
            problems.append(f"{f.name}: not written and without a default")
    return problems


def read_as(df: DataFrame, writer: TableContract, reader: TableContract) -> DataFrame:
    """Data of the writer as the reader wants it: by name, with defaults, unknown columns skipped.

    A default stands in for a field that was not written. A NULL that was written stays one, unless the
    reader requires the field and so has no place for it.
    """
    problems = reading_problems(writer, reader)
    if problems:
        raise Incompatible("; ".join(problems))
    written = set(writer.names) & set(df.columns)
    columns = []
    for f in reader.fields:
        default = None if f.default is NO_DEFAULT else f.default
        if f.name in written:
            value = F.col(f.name).cast(f.type)
            columns.append((F.coalesce(value, F.lit(default).cast(f.type)) if f.required and default is not None else value).alias(f.name))
        else:
            columns.append(F.lit(default).cast(f.type).alias(f.name))
    return df.select(*columns)


def compatibility(old: TableContract, new: TableContract) -> dict:
    """backward: the new contract reads old data; forward: the old one reads new data."""
    backward, forward = reading_problems(old, new), reading_problems(new, old)
    return {
        "backward": not backward,
        "forward": not forward,
        "verdict": "register" if not backward and not forward else "reject",
        "problems": backward + forward,
    }
