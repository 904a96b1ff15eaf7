"""Error injection with a log: dirty copies of clean tables on which detectors can be scored.

Rows are chosen by a hash of their key in disjoint slots, so two injectors never touch the same
cell and every engine or rerun makes the same dirt. Each injector is one column expression; the
log is the difference of both versions, taken in the same projection.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truegrain.operators.ranks import with_bucket
from truegrain.session import materialize

LOG = ["table_name", "row_id", "column", "error_type", "clean_value", "dirty_value"]
SLOTS = 1_000_000


@dataclass(frozen=True)
class Injector:
    """Rows in [slot, slot + share) of the hash get `value` in `column`. `where` narrows them."""

    column: str
    error_type: str
    value: Callable[[], Column]
    share: float = 0.0
    where: Callable[[], Column] | None = None
    rows: Callable[[], Column] | None = None  # explicit choice instead of the hash share


def hash_slot(*key: str, seed: int = 0) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in key]), F.lit(SLOTS))


def inject(
    df: DataFrame, table: str, row_id: Column, injectors: list[Injector], key: list[str], seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """(dirty table, error log). Hash shares are laid out one after the other.

    An injector with explicit `rows` fires where no earlier injector has touched the column.
    """
    out = df.withColumn("_slot", hash_slot(*key, seed=seed)).withColumn("_row_id", row_id.cast("string"))
    start = 0
    for i, inj in enumerate(injectors):
        if inj.rows is not None:
            chosen = inj.rows()
        else:
            stop = start + round(inj.share * SLOTS)
            chosen = (F.col("_slot") >= start) & (F.col("_slot") < stop)
            start = stop
        if inj.where is not None:
            chosen = chosen & inj.where()
        for j, earlier in enumerate(injectors[:i]):
            if earlier.column == inj.column:
                chosen = chosen & ~F.col(f"_hit{j}")
        out = out.withColumn(f"_hit{i}", F.coalesce(chosen, F.lit(False)))
    dirty = {}
    log = []
    for c in df.columns:
        mine = [(i, inj) for i, inj in enumerate(injectors) if inj.column == c]
        value = F.col(c)
        for i, inj in mine:
            value = F.when(F.col(f"_hit{i}"), inj.value().cast(df.schema[c].dataType)).otherwise(value)
        dirty[c] = value
        for i, inj in mine:
            changed = ~F.col(c).eqNullSafe(inj.value().cast(df.schema[c].dataType))
            log.append(
                F.when(
                    F.col(f"_hit{i}") & changed,
                    F.struct(
                        F.lit(table).alias("table_name"),
                        F.col("_row_id").alias("row_id"),
                        F.lit(c).alias("column"),
                        F.lit(inj.error_type).alias("error_type"),
                        F.col(c).cast("string").alias("clean_value"),
                        inj.value().cast(df.schema[c].dataType).cast("string").alias("dirty_value"),
                    ),
                )
            )
    return (
        out.select(*[v.alias(c) for c, v in dirty.items()]),
        out.select(F.inline(F.array_compact(F.array(*log)))),
    )


def _log(rows: DataFrame, table: str, row_id: Column, column: str, error_type: str, clean, dirty) -> DataFrame:
    as_text = lambda v: v.cast("string") if isinstance(v, Column) else F.lit(v).cast("string")
    return rows.select(
        F.lit(table).alias("table_name"), row_id.cast("string").alias("row_id"), F.lit(column).alias("column"),
        F.lit(error_type).alias("error_type"), as_text(clean).alias("clean_value"), as_text(dirty).alias("dirty_value"),
    )


# ---- values ---------------------------------------------------------------------------------


def scaled(column: str, factor: float) -> Callable[[], Column]:
    """Wrong unit (1000), outlier (10), bad scale (1.15), sign flip (-1)."""
    return lambda: F.col(column) * F.lit(factor)


def fixed(value) -> Callable[[], Column]:
    return lambda: F.lit(value)


def variant_of(column: str, spellings: dict[str, list[str]], *key: str) -> Callable[[], Column]:
    """A misspelt category, chosen among its spellings by the row's hash."""

    def value():
        table = F.create_map(
            *[x for k, vs in spellings.items() for x in (F.lit(k), F.array(*[F.lit(v) for v in vs]))]
        )
        found = F.element_at(table, F.col(column))
        place = (F.pmod(F.xxhash64(F.lit("spelling"), *[F.col(k) for k in key]), F.size(found).cast("bigint")) + 1).cast("int")
        return F.when(found.isNull(), F.col(column)).otherwise(F.element_at(found, place))

    return value


def drop_char(column: str, position: int = 3) -> Callable[[], Column]:
    return lambda: F.concat(F.substring(column, 1, position - 1), F.substr(F.col(column), F.lit(position + 1)))


def swap_chars(column: str, position: int = 2) -> Callable[[], Column]:
    c = column
    return lambda: F.concat(
        F.substring(c, 1, position - 1), F.substring(c, position + 1, 1), F.substring(c, position, 1),
        F.substr(F.col(c), F.lit(position + 2)),
    )


def typo(column: str, *key: str) -> Callable[[], Column]:
    """Drop a character or swap two neighbours, by the row's hash."""
    return lambda: F.when(
        F.pmod(F.xxhash64(F.lit("typo"), *[F.col(k) for k in key]), F.lit(2)) == 0, drop_char(column)()
    ).otherwise(swap_chars(column)())


def next_reference(column: str, count: int, first: int = 0) -> Callable[[], Column]:
    """A wrong but valid id: the next one of a dense id range, cyclic."""
    return lambda: (F.col(column) - first + 1) % count + first


def successors(ids: DataFrame, column: str) -> DataFrame:
    """(id, next_id): the next greater id that exists, after the last one the first; NULLs are no ids.

    Ids are cut into buckets of about equal size. The last id of a bucket is followed by the first one of
    the next bucket, so only one row per bucket meets in one task. A single id follows itself.
    """
    found = materialize(ids.select(F.col(column).alias("id")).filter(F.col("id").isNotNull()).distinct(), "ids")
    rows = materialize(with_bucket(found, "id"), "bucketed")
    firsts = rows.groupBy("_bucket").agg(F.min("id").alias("_low"))
    after = firsts.select("_bucket", F.coalesce(F.lead("_low").over(Window.orderBy("_bucket")), F.min("_low").over(Window.partitionBy())).alias("_after"))
    following = F.lead("id").over(Window.partitionBy("_bucket").orderBy("id"))
    return rows.withColumn("_next", following).join(after, "_bucket").select("id", F.coalesce("_next", "_after").alias("next_id"))


def with_successor(df: DataFrame, column: str, ids: DataFrame, id_column: str, name: str = "next_id") -> DataFrame:
    """`df` with the next existing id after `column`, NULL where `column` holds none of the ids."""
    following = successors(ids, id_column).select(F.col("id").alias("_id"), F.col("next_id").alias(name))
    return df.join(following, F.col(column) == F.col("_id"), "left").drop("_id")


def next_existing(column: str, name: str = "next_id") -> Callable[[], Column]:
    """A wrong but valid id, from `with_successor`; an id that does not exist stays."""
    return lambda: F.coalesce(F.col(name), F.col(column))


def other_column(column: str) -> Callable[[], Column]:
    return lambda: F.col(column).cast("string")


def transposed(column: str) -> Callable[[], Column]:
    """Two-digit whole numbers with their digits exchanged."""
    c = F.col
    return lambda: F.when(
        (c(column) == F.floor(c(column))) & c(column).between(10, 99),
        (c(column) % 10) * 10 + F.floor(c(column) / 10),
    ).otherwise(c(column))


def decimal_comma(column: str) -> Callable[[], Column]:
    return lambda: F.replace(F.col(column), F.lit("."), F.lit(","))


def bad_check_digit(column: str) -> Callable[[], Column]:
    digit = lambda: (F.substring(column, 13, 1).try_cast("int") + 1) % 10
    return lambda: F.concat(F.substring(column, 1, 12), digit().cast("string"))


def as_inches(column: str) -> Callable[[], Column]:
    return lambda: F.round(F.col(column) / 2.54, 1)


# ---- rows -----------------------------------------------------------------------------------


def drop_rows(df: DataFrame, table: str, row_id: Column, chosen: Column) -> tuple[DataFrame, DataFrame]:
    """Missing records, each in the log."""
    hit = F.coalesce(chosen, F.lit(False))
    return df.filter(~hit), _log(df.filter(hit), table, row_id, "*", "missing_record", "record", None)


def copy_rows(
    df: DataFrame, table: str, id_column: str, chosen: Column, new_id: Column,
    later: dict[str, Column] | None = None, near: Column | None = None, near_values: dict[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Exact copies under a new id and a later entry time; `near` rows change some values as well."""
    near = F.lit(False) if near is None else near
    source = df.filter(F.coalesce(chosen, F.lit(False)))
    changes = dict(later or {})
    for c, v in (near_values or {}).items():
        changes[c] = F.when(near, v).otherwise(F.col(c))
    columns = []
    for c in df.columns:
        value = new_id if c == id_column else changes.get(c, F.col(c))
        columns.append(value.cast(df.schema[c].dataType).alias(c))
    kind = F.when(near, "near_duplicate").otherwise("duplicate_record")
    log = source.select(
        F.lit(table).alias("table_name"), new_id.cast("string").alias("row_id"), F.lit("*").alias("column"), kind.alias("error_type"),
        F.lit(None).cast("string").alias("clean_value"), F.concat(F.lit("copy of "), F.col(id_column).cast("string")).alias("dirty_value"),
    )
    return df.unionByName(source.select(*columns)), log


def double_upload(df: DataFrame, table: str, row_id: Column, chosen: Column) -> tuple[DataFrame, DataFrame]:
    """A segment that was sent twice, unchanged."""
    twice = df.filter(F.coalesce(chosen, F.lit(False)))
    return df.unionByName(twice), _log(twice, table, row_id, "*", "duplicate_record", None, "uploaded twice")


# ---- events and drift -----------------------------------------------------------------------


def disturb_events(
    events: DataFrame, event_id: str, event_time: str, arrival: str, late: Column, delay_seconds: Column,
    skewed: Column, skew: str, resent: Column, resend_seconds: int = 30,
) -> DataFrame:
    """Late arrivals, devices with a wrong clock, and events that are sent again under one id."""
    moved = events.withColumn(
        arrival,
        F.when(late, F.col(arrival) + F.make_dt_interval(secs=delay_seconds)).otherwise(F.col(arrival)),
    ).withColumn(
        event_time, F.when(skewed, F.col(event_time) + F.expr(f"INTERVAL {skew}")).otherwise(F.col(event_time))
    )
    again = moved.filter(resent).withColumn(
        arrival, F.col(arrival) + F.make_dt_interval(secs=F.lit(resend_seconds))
    )
    return moved.unionByName(again)


def demand_shift(column: str, date: str, start: str, factor: float, where: Column) -> Column:
    """A segment sells `factor` times as much from a day on."""
    hit = where & (F.col(date) >= F.lit(start).cast("date"))
    return F.when(hit, F.col(column) * F.lit(factor)).otherwise(F.col(column))


def sensor_creep(column: str, date: str, start: str, daily: float, where: Column) -> Column:
    """Readings that grow by a share per day after a start date."""
    days = F.greatest(F.datediff(F.col(date), F.to_date(F.lit(start))), F.lit(0))
    return F.when(where, F.col(column) * (1 + F.lit(daily) * days)).otherwise(F.col(column))


def unit_switch(column: str, date: str, start: str, factor: float, offset: float, where: Column) -> Column:
    """From a day on a segment reports factor * x + offset (kg to lb, C to F)."""
    hit = where & (F.col(date) >= F.lit(start).cast("date"))
    return F.when(hit, F.col(column) * F.lit(factor) + F.lit(offset)).otherwise(F.col(column))


def checkout_errors(
    lines: DataFrame, quantity: str, bad_scale: Column, look_alike: Column, no_tare: Column, tare: float = 0.02
) -> DataFrame:
    """Recorded quantity and cause of wrong checkout lines; the true quantity stays beside it."""
    cause = F.when(bad_scale, "bad scale").when(look_alike, "look-alike code").when(no_tare, "missing tare")
    recorded = (
        F.when(cause == "bad scale", F.col(quantity) * 1.15)
        .when(cause == "missing tare", F.col(quantity) + F.lit(tare))
        .otherwise(F.col(quantity))
    )
    return lines.withColumn("true_quantity", F.col(quantity)).withColumn(
        "error_cause", cause
    ).withColumn(quantity, recorded).withColumn("was_corrected", cause.isNotNull())
