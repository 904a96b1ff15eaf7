"""Contract validation. Row checks are one narrow projection; only keys and references shuffle."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.operators.ranks import join_back
from truegrain.operators.windows import duplicates_beyond_first
from truegrain.plans.contract import FieldRule, TableContract
from truegrain.session import materialize

FAILURE = "array<struct<column:string,check:string,value:string,kind:string>>"


def _failure(condition: Column, column: str, check: str, value: Column, kind: str) -> Column:
    return F.when(
        F.coalesce(condition, F.lit(False)),
        F.struct(
            F.lit(column).alias("column"),
            F.lit(check).alias("check"),
            value.cast("string").alias("value"),
            F.lit(kind).alias("kind"),
        ),
    )


def field_failures(df: DataFrame, rule: FieldRule) -> list[Column]:
    """One optional failure per check of a column, in the order a reader would name them."""
    raw = F.col(f"`{rule.name}`")
    source = df.schema[rule.name].dataType.simpleString()
    value = raw if source == rule.type else raw.try_cast(rule.type)
    found = []

    def add(condition, check, kind="constraint"):
        found.append(_failure(condition, rule.name, check, raw, kind))

    if source != rule.type:
        add(raw.isNotNull() & value.isNull(), f"type {rule.type}", "conversion")
    if rule.required:
        add(raw.isNull(), "required")
    if rule.minimum is not None:
        add(value < F.lit(rule.minimum), f">= {rule.minimum}")
    if rule.above is not None:
        add(value <= F.lit(rule.above), f"> {rule.above}")
    if rule.maximum is not None:
        add(value > F.lit(rule.maximum), f"<= {rule.maximum}")
    if rule.below is not None:
        add(value >= F.lit(rule.below), f"< {rule.below}")
    if rule.allowed is not None:
        add(~value.isin(list(rule.allowed)), "in set")
    if rule.pattern is not None:
        add(~raw.rlike(f"^(?:{rule.pattern.removeprefix('^').removesuffix('$')})$"), "pattern")
    if rule.min_length is not None:
        add(F.length(raw) < rule.min_length, f"length >= {rule.min_length}")
    if rule.max_length is not None:
        add(F.length(raw) > rule.max_length, f"length <= {rule.max_length}")
    for name, predicate in rule.checks:
        add(~predicate(value), name)
    return found


def row_failures(df: DataFrame, contract: TableContract) -> Column:
    """All failures one row can show by itself, as an array column."""
    found = []
    for rule in contract.fields:
        if rule.name in df.columns:
            found += field_failures(df, rule)
        else:
            found.append(_failure(F.lit(rule.required), rule.name, "column missing", F.lit(None), "schema"))
    if not contract.allow_extra:
        for extra in [c for c in df.columns if c not in contract.names]:
            found.append(_failure(F.col(f"`{extra}`").isNotNull(), extra, "unexpected column", F.col(f"`{extra}`"), "schema"))
    for name, predicate in contract.row_checks:
        found.append(_failure(~predicate(), "*", name, F.lit(None), "constraint"))
    return F.array_compact(F.array(*found)).cast(FAILURE)


def flag_rows(df: DataFrame, contract: TableContract, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Add `failures`. Every member of a duplicate key fails; a NULL foreign key is legal."""
    out = df.withColumn("failures", row_failures(df, contract))
    for i, key in enumerate(contract.keys):
        if any(k not in df.columns for k in key):
            continue
        groups = (
            df.groupBy(*key)
            .agg(F.count(F.lit(1)).alias("_n"))
            .filter((F.col("_n") > 1) & F.coalesce(*[F.col(k).cast("string") for k in key]).isNotNull())
        )
        out = join_back(out, groups, list(key), "left")
        failure = F.array_compact(F.array(_failure(
            F.col("_n").isNotNull(), ",".join(key), "unique", F.concat_ws("|", *[F.col(k).cast("string") for k in key]), "constraint"
        )))
        out = out.withColumn("failures", F.concat("failures", failure.cast(FAILURE))).drop("_n")
    for fk in contract.foreign_keys:
        parent = (parents or {}).get(fk.parent)
        if parent is None or fk.column not in df.columns:
            continue
        known = parent.select(F.col(fk.parent_column).cast("string").alias("_pk")).distinct()
        known = known.withColumn("_hit", F.lit(True))
        out = out.join(known, F.col(fk.column).cast("string") == F.col("_pk"), "left")
        failure = F.array_compact(F.array(_failure(
            F.col(fk.column).isNotNull() & F.col("_hit").isNull(), fk.column, f"exists in {fk.parent}", F.col(fk.column), "constraint"
        )))
        out = out.withColumn("failures", F.concat("failures", failure.cast(FAILURE))).drop("_pk", "_hit")
    return out


def validate(df, contract, row_id: list[str], parents=None) -> DataFrame:
    """All failures at once: (row id, column, check, value)."""
    return (
        flag_rows(df, contract, parents)
        .select(*row_id, F.explode("failures").alias("f"))
        .select(*row_id, "f.column", "f.check", "f.value")
    )


def reason_text(failures: str = "failures") -> Column:
    return F.array_join(
        F.transform(
            F.col(failures),
            lambda f: F.concat_ws(
                " ", f["column"], f["check"], F.concat(F.lit("["), f["value"], F.lit("]"))
            ),
        ),
        "; ",
    )


def quarantine(df, contract, parents=None, passes: int = 1) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with `reason`). More passes look again after bad rows have left."""
    good, bad = df, None
    for _ in range(passes):
        flagged = flag_rows(good, contract, parents)
        if passes > 1:
            flagged = materialize(flagged, "quarantine")
        rejected = flagged.filter(F.size("failures") > 0).withColumn("reason", reason_text()).drop("failures")
        bad = rejected if bad is None else bad.unionByName(rejected)
        good = flagged.filter(F.size("failures") == 0).drop("failures")
    return good, bad


def first_reason(failures: str = "failures") -> Column:
    return F.element_at(F.col(failures), 1)


def ddl_load(
    batch: DataFrame, existing: DataFrame, contract: TableContract, order: list[str], parents=None
) -> DataFrame:
    """Row-by-row load into a table with constraints: `error` and `reason` are NULL where accepted.

    Keys must be new to the table and to earlier rows of the batch that are otherwise fine.
    Conversions come first, then NOT NULL and CHECK, references, and keys; a refused row takes no key,
    and the reason names the first declared key that is taken.
    """
    bare = TableContract(contract.name, contract.fields, (), contract.foreign_keys, contract.row_checks)
    bare = TableContract(
        bare.name, tuple(FieldRule(**{**f.__dict__, "unique": False}) for f in bare.fields), (),
        bare.foreign_keys, bare.row_checks, contract.allow_extra,
    )
    first = F.element_at(
        F.concat(
            F.filter("failures", lambda f: f["kind"] == "conversion"),
            F.filter("failures", lambda f: f["kind"] != "conversion"),
        ),
        1,
    )
    out = flag_rows(batch, bare, parents).withColumn(
        "_first", F.when(F.size("failures") > 0, first)
    ).select(
        *batch.columns,
        F.col("_first.kind").alias("error"),
        F.concat_ws(" ", F.col("_first.column"), F.col("_first.check")).alias("_r"),
    ).withColumn("reason", F.when(F.col("error").isNotNull(), F.col("_r"))).drop("_r")
    return _load_keys(out, existing, [list(k) for k in contract.keys], batch.columns, order)


def _load_keys(out: DataFrame, existing: DataFrame, keys: list[list[str]], columns: list[str], order: list[str]) -> DataFrame:
    """Refuse rows whose key is taken by the table or by an earlier accepted row; a NULL in a key takes nothing.

    In each round an undecided row is accepted if it is the first undecided one of each of its keys,
    and refused if an accepted row holds one of them. The first undecided row is always decided, and
    a refused row frees its other keys, as in a load row by row.
    """
    if not keys:
        return out
    spots = F.array_compact(F.array(*[
        F.when(_all_present(k), F.struct(F.lit(i).alias("i"), F.to_json(F.array(*[F.col(c).cast("string") for c in k])).alias("v")))
        for i, k in enumerate(keys)
    ]))

    def exploded(df: DataFrame, *kept: str) -> DataFrame:
        return df.withColumn("_k", F.explode(spots)).select(*kept, F.col("_k.i").alias("_i"), F.col("_k.v").alias("_v"))

    place = F.struct(*order).alias("_o")
    held = [
        existing.filter(_all_present(k)).select(F.lit(i).alias("_i"), F.to_json(F.array(*[F.col(c).cast("string") for c in k])).alias("_v"))
        for i, k in enumerate(keys) if all(c in existing.columns for c in k)
    ]
    in_table = None
    for h in held:
        in_table = h if in_table is None else in_table.unionByName(h)
    rows = materialize(exploded(out.filter("error IS NULL").select("*", place), "_o"), "load-keys")
    refused_at = rows.limit(0)
    if in_table is not None:
        refused_at = materialize(rows.join(in_table.distinct(), ["_i", "_v"], "left_semi"), "load-taken")
    open_rows = materialize(rows.join(refused_at.select("_o").distinct(), "_o", "left_anti"), "load-open")
    accepted = rows.limit(0)
    while not open_rows.isEmpty():
        firsts = open_rows.groupBy("_i", "_v").agg(F.min("_o").alias("_first"))
        later = open_rows.join(firsts, ["_i", "_v"]).filter(F.col("_o") != F.col("_first")).select("_o").distinct()
        won = materialize(open_rows.join(later, "_o", "left_anti"), "load-won")
        accepted = accepted.unionByName(won)
        lost = open_rows.join(won.select("_i", "_v"), ["_i", "_v"], "left_semi").select("_o").distinct()
        open_rows = materialize(open_rows.join(lost, "_o", "left_anti"), "load-open")
    winners = accepted.select(F.col("_i"), F.col("_v"), F.col("_o").alias("_by"))
    clashes = rows.join(winners, ["_i", "_v"]).filter(F.col("_by") < F.col("_o")).select("_o", "_i")
    first = refused_at.select("_o", "_i").unionByName(clashes).groupBy("_o").agg(F.min("_i").alias("_i"))
    names = F.element_at(F.array(*[F.lit(f"{','.join(k)} duplicate key") for k in keys]), F.col("_i") + 1)
    hit = F.col("_i").isNotNull()
    return out.withColumn("_o", F.struct(*order)).join(first, "_o", "left").select(
        *columns,
        F.when(hit, F.lit("constraint")).otherwise(F.col("error")).alias("error"),
        F.when(hit, names).otherwise(F.col("reason")).alias("reason"),
    )


def _all_present(names: list[str]) -> Column:
    out = F.col(names[0]).isNotNull()
    for c in names[1:]:
        out = out & F.col(c).isNotNull()
    return out


class BatchRefused(ValueError):
    """A whole batch was refused because some row breaks the contract."""


def atomic_gate(df, contract, parents=None) -> DataFrame:
    """The batch, or an exception if any row fails; stops at the first failing row.

    The batch is written once: what comes back is what was checked, and is not computed again.
    """
    batch = materialize(df, "gate")
    bad = flag_rows(batch, contract, parents).filter(F.size("failures") > 0).limit(1).collect()
    if bad:
        f = bad[0]["failures"][0]
        raise BatchRefused(f"{contract.name}: {f['column']} {f['check']} [{f['value']}]")
    return batch


def requires(contract: TableContract, parents=None):
    """Decorator for DataFrame functions: the first argument must keep the contract."""

    def wrap(function):
        @wraps(function)
        def inner(df, *args, **kwargs):
            return function(atomic_gate(df, contract, parents), *args, **kwargs)

        return inner

    return wrap


def schema_difference(df: DataFrame, contract: TableContract) -> dict[str, list[str]]:
    """Missing, unexpected and differently typed columns, from the schema alone."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return {
        "missing": [f.name for f in contract.fields if f.name not in have and f.required],
        "unexpected": [c for c in have if c not in contract.names],
        "type": [f.name for f in contract.fields if f.name in have and have[f.name] != f.type],
    }


def validate_on_write(df, contract, path: str, fmt: str = "parquet", parents=None, mode: str = "error"):
    """Write only a table that keeps its contract, in schema and in every row."""
    diff = schema_difference(df, contract)
    if diff["missing"] or diff["type"] or (diff["unexpected"] and not contract.allow_extra):
        raise BatchRefused(f"{contract.name}: {diff}")
    atomic_gate(df, contract, parents).write.format(fmt).mode(mode).save(path)


def threshold_alerts(metrics: DataFrame, thresholds: list[dict]) -> DataFrame:
    """Long metrics (when, metric, value) against min/max per metric; the limits are plan constants."""
    spark = metrics.sparkSession
    limits = spark.createDataFrame(
        [
            (t["metric"], *(None if t.get(k) is None else float(t[k]) for k in ("min", "max")), t["owner"])
            for t in thresholds
        ],
        "metric string, min double, max double, owner string",
    )
    out_of = (F.col("value") > F.col("max")) | (F.col("value") < F.col("min"))
    return metrics.join(F.broadcast(limits), "metric").filter(F.coalesce(out_of, F.lit(False)))


def test_report(metrics: DataFrame, tests: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Pass or fail per batch and test; a test without a metric fails."""
    spark = metrics.sparkSession
    plan = spark.createDataFrame(
        [(m, lo, hi) for m, (lo, hi) in tests.items()], "metric string, lo double, hi double"
    )
    inside = F.coalesce(F.col("value") >= F.col("lo"), F.lit(True)) & F.coalesce(
        F.col("value") <= F.col("hi"), F.lit(True)
    )
    return metrics.join(F.broadcast(plan), "metric").withColumn(
        "passed", F.coalesce(inside & F.col("value").isNotNull(), F.lit(False))
    )


test_report.__test__ = False
