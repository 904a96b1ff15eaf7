"""Cross-table checks: lookups, coverage, referential integrity and invariants across sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.functions.predicates import as_col, null_safe_ne
from truegrain.functions.scalars import pad_code
from truegrain.operators.ranks import running
from truegrain.operators.windows import previous_value




def lookup(df: DataFrame, reference: DataFrame, on: Column) -> DataFrame:
    """Left join to a reference table, broadcast only when its counted size allows."""
    return df.join(reference, on, "left")


def catalog_consistency(
    fact: DataFrame, catalog: DataFrame, on: Column, fact_value, catalog_value, tolerance: float = 0.005
) -> DataFrame:
    """Fact rows whose value is off the catalog value by more than the tolerance."""
    gap = F.abs(as_col(fact_value) - as_col(catalog_value))
    return fact.join(catalog, on).filter(gap > F.lit(tolerance))


def within_tolerance(measured, audited, relative: float = 0.05, absolute: float = 0.5) -> Column:
    m, a = as_col(measured), as_col(audited)
    return F.abs(m - a) <= F.lit(relative) * a + F.lit(absolute)


def audit_accuracy(df: DataFrame, audit: DataFrame, keys: list[str], measured: str, audited: str):
    """Share of measured values within tolerance of the audit, on a multi-column key."""
    good = within_tolerance(measured, audited)
    return df.join(audit, keys).agg(F.avg(good.cast("int")).alias("score"))


def derived_key_join(left: DataFrame, right: DataFrame, left_key: Column, right_key: str) -> DataFrame:
    """Equi join on a key computed on the left, e.g. the day of a timestamp."""
    return left.withColumn("_key", left_key).join(
        right.withColumnRenamed(right_key, "_key"), "_key"
    ).drop("_key")


def coverage(events: DataFrame, reports: DataFrame, keys: list[str]) -> DataFrame:
    """Share of events that a report matches; several matches count several times, as a join does.

    The reports are counted per key first, so a hot key is one row and not a fan-out.
    """
    counted = reports.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    joined = events.join(counted, keys, "left").withColumn("_m", F.coalesce("_n", F.lit(0)))
    return joined.agg((F.sum("_m") / F.sum(F.greatest("_m", F.lit(1)))).alias("score"))


def dangling(child: DataFrame, parent: DataFrame, fk: str, pk: str, null_fk_ok: bool = True) -> DataFrame:
    """Child rows whose foreign key has no parent; a NULL key is legal unless said otherwise."""
    parents = parent.select(F.col(pk).alias("_pk")).distinct()
    missing = child.join(parents, F.col(fk) == F.col("_pk"), "left_anti")
    return missing.filter(F.col(fk).isNotNull()) if null_fk_ok else missing


def cheaper_although_bigger(df: DataFrame, family: str, size: str, price: str) -> DataFrame:
    """Rows for which a smaller member of the family costs more.

    No pairs: per (family, size) the highest price, then the running maximum over smaller sizes.
    """
    priced = df.filter(F.col(price).isNotNull() & F.col(size).isNotNull() & F.col(family).isNotNull())
    tops = priced.groupBy(family, size).agg(F.max(price).alias("_top"))
    limits = running(tops, [family], size, {"_limit": ("max", "_top")}, inclusive=False)
    return (
        priced.join(limits.select(family, size, "_limit"), [family, size])
        .filter(F.col(price) < F.col("_limit"))
        .drop("_limit")
    )


def oversold(
    sales: DataFrame, stock: DataFrame, arrivals: DataFrame, keys: list[str], date: str,
    sold: str, on_hand: str, arrived: str, slack: float = 1.0,
) -> DataFrame:
    """Sold more than the previous stock plus the arrivals of the day (plus a slack).

    Arrivals are summed before the join; a first day has no previous stock and never fires.
    """
    before = previous_value(stock, keys, date, on_hand, "_before").select(*keys, date, "_before")
    came = arrivals.groupBy(*keys, date).agg(F.sum(arrived).alias("_came"))
    return (
        sales.join(before, [*keys, date])
        .join(came, [*keys, date], "left")
        .filter(F.col(sold) > F.col("_before") + F.coalesce("_came", F.lit(0.0)) + F.lit(slack))
        .drop("_before", "_came")
    )


def flag_members(df: DataFrame, ids: DataFrame, key: str, name: str) -> DataFrame:
    """Boolean membership of the row id in a set of ids."""
    wanted = ids.select(F.col(key)).distinct().withColumn(name, F.lit(True))
    return df.join(wanted, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def key_as_text_audit(left: DataFrame, right: DataFrame, key: str, width: int) -> DataFrame:
    """How many left rows match when the key lost its leading zeros, and when it is padded again."""
    codes = right.select(F.col(key).alias("_code")).distinct()
    raw = F.col(key).try_cast("bigint").cast("string")
    tried = left.select(raw.alias("_raw"), pad_code(raw, width).alias("_padded"))
    by_raw = codes.select(F.col("_code").alias("_raw"), F.lit(1).alias("_a"))
    by_pad = codes.select(F.col("_code").alias("_padded"), F.lit(1).alias("_b"))
    return (
        tried.join(by_raw, "_raw", "left")
        .join(by_pad, "_padded", "left")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("_a").alias("matched_as_number"),
            F.count("_b").alias("matched_as_text"),
        )
    )


def seasonal_windows(
    df: DataFrame, date: str, first_week: str, last_week: str,
    offset_days: int = 378, length_days: int = 35,
) -> DataFrame:
    """Label each row with the weeks it serves, as current week or as seasonal reference.

    A row names its weeks by date arithmetic and is exploded to them: no join at all. The current
    week holds 7 days from its Monday-like start; the reference starts `offset_days` earlier.
    """
    day = F.col(date).cast("date")
    start, end = F.to_date(F.lit(first_week)), F.to_date(F.lit(last_week))
    place = F.datediff(day, start)
    own = F.floor(place / 7)
    # reference of week w: place in [7w - offset, 7w - offset + length - 1]
    low = F.ceil((place + offset_days - (length_days - 1)) / 7)
    high = F.floor((place + offset_days) / 7)
    last = F.floor(F.datediff(end, start) / 7)
    current = F.when(
        own.between(0, last), F.array(F.struct(own.cast("int").alias("w"), F.lit(False).alias("ref")))
    ).otherwise(F.array().cast("array<struct<w:int,ref:boolean>>"))
    lo, hi = F.greatest(low, F.lit(0)), F.least(high, last)
    reference = F.when(
        lo <= hi,
        F.transform(
            F.sequence(lo.cast("int"), hi.cast("int")),
            lambda w: F.struct(w.alias("w"), F.lit(True).alias("ref")),
        ),
    ).otherwise(F.array().cast("array<struct<w:int,ref:boolean>>"))
    return (
        df.withColumn("_serves", F.explode(F.concat(current, reference)))
        .withColumn("week", F.date_add(start, F.col("_serves.w") * 7))
        .withColumn("is_reference", F.col("_serves.ref"))
        .drop("_serves")
    )


def map_values(df: DataFrame, column: str, mapping: dict[str, str]) -> Column:
    """Spelling to canonical value; unknown values stay as they are."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(pairs, F.col(column)), F.col(column))


def reference_violations(df, reference, on, value, expected) -> DataFrame:
    """Rows that differ from the reference; a missing reference row is a violation as well."""
    return lookup(df, reference, on).filter(null_safe_ne(value, expected))
