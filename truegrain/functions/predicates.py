"""Boolean Column builders. A NULL input stays NULL unless the docstring says otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def in_set(col, values) -> Column:
    return as_col(col).isin(list(values))


def parses_positive(col, type_name: str = "double") -> Column:
    """Castable and above zero; NULL and unparsable text count as bad."""
    return F.coalesce(as_col(col).try_cast(type_name) > 0, F.lit(False))


def parses_as(col, type_name: str) -> Column:
    return as_col(col).isNotNull() & as_col(col).try_cast(type_name).isNotNull()


def present(*cols) -> Column:
    return all_of([as_col(c).isNotNull() for c in cols])


def full_match(col, pattern: str) -> Column:
    """Whole-string regular expression."""
    return as_col(col).rlike(f"^(?:{pattern})$")


def in_range(col, lo=None, hi=None, include_lo: bool = True, include_hi: bool = True) -> Column:
    c = as_col(col)
    parts = []
    if lo is not None:
        parts.append(c >= F.lit(lo) if include_lo else c > F.lit(lo))
    if hi is not None:
        parts.append(c <= F.lit(hi) if include_hi else c < F.lit(hi))
    return all_of(parts) if parts else F.lit(True)


def before(first, second, or_equal: bool = False) -> Column:
    a, b = as_col(first), as_col(second)
    return a <= b if or_equal else a < b


def within_interval(start, end, interval: str, strict: bool = False) -> Column:
    """end - start at most (or, strict, below) an interval literal such as '24 HOURS'."""
    gap = as_col(end) - as_col(start)
    limit = F.expr(f"INTERVAL {interval}")
    return gap < limit if strict else gap <= limit


def conditional_set(category, value, allowed: dict, default) -> Column:
    """The set of legal values depends on a category; NULL or unknown categories use `default`."""
    cat, val = as_col(category), as_col(value)
    out = None
    for key, values in allowed.items():
        branch = val.isin(list(values))
        out = F.when(cat == key, branch) if out is None else out.when(cat == key, branch)
    fallback = val.isin(list(default))
    return fallback if out is None else out.otherwise(fallback)


def implies(condition: Column, consequence: Column) -> Column:
    return ~condition | consequence


def null_safe_ne(a, b) -> Column:
    return ~as_col(a).eqNullSafe(as_col(b))


def placeholder(col, values) -> Column:
    """A stand-in for a missing value. NULL itself is not a placeholder."""
    return F.coalesce(as_col(col).isin(list(values)), F.lit(False))


def date_in_period(col, start: str, end: str) -> Column:
    return as_col(col).cast("date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))


def month_batch(df: DataFrame, col: str, start: str) -> DataFrame:
    """The rows of one calendar month, as a half-open range that reaches the file scan."""
    kind = df.schema[col].dataType.typeName()
    first = F.lit(start).cast(kind)
    following = F.add_months(F.to_date(F.lit(start)), 1).cast(kind)
    return df.filter((F.col(col) >= first) & (F.col(col) < following))


def half_open(col, start, end) -> Column:
    return (as_col(col) >= start) & (as_col(col) < end)


def length_between(col, lo: int, hi: int) -> Column:
    return F.length(as_col(col)).between(lo, hi)


def similar_inputs(df: DataFrame, **equal) -> DataFrame:
    return df.filter(all_of([F.col(k) == v for k, v in equal.items()])) if equal else df


def whole_number_if(value, condition: Column) -> Column:
    c = as_col(value)
    return F.when(condition, c == F.floor(c)).otherwise(F.lit(True))


def lossy_cast(col) -> Column:
    """Accepted as an integer, but not the number that was written ('75.5' stored as 76)."""
    number = as_col(col).try_cast("double")
    return F.coalesce(number != F.round(number), F.lit(False))


def type_is(df: DataFrame, col: str, type_name: str) -> bool:
    return df.schema[col].dataType.simpleString() == type_name
