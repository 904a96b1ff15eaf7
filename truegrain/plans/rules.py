"""Rules as data. A rule says which rows of a table break it; a report scores the findings against a log.

Row conditions of one table run in one projection; unique keys, references and comparisons with other
tables are frames of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.operators.diff import union_all
from truegrain.operators.joins import dangling
from truegrain.operators.windows import duplicates_beyond_first

Tables = dict[str, DataFrame]
Expression = str | Callable[[], Column]  # SQL text, or a function that makes a column


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str
    action: str  # reject, flag or repair
    table: str
    row_id: Expression
    good: Expression | None = None  # of a row; NULL counts as good
    find: Callable[[Tables], DataFrame] | None = None  # the rows that break the rule


def _column(e: Expression) -> Column:
    return F.expr(e) if isinstance(e, str) else e()


def holds(name: str, action: str, table: str, good: Expression, row_id: Expression = "id") -> Rule:
    """Every row meets a condition; rules of the same name may cover several tables."""
    return Rule(name, "row condition", action, table, row_id, good=good)


def unique(name: str, action: str, table: str, keys: list[str], order: list[str], row_id: Expression = "id") -> Rule:
    """The first row of a key by `order` is good, all later ones are not."""
    return Rule(name, "uniqueness", action, table, row_id,
                find=lambda t: duplicates_beyond_first(t[table], keys, order))


def refers(name: str, action: str, table: str, key: str, parent: str, parent_key: str = "id", row_id: Expression = "id") -> Rule:
    """The key is there and known to the parent table."""
    return Rule(name, "reference", action, table, row_id,
                find=lambda t: dangling(t[table], t[parent], key, parent_key, null_fk_ok=False))


def agrees(
    name: str, action: str, table: str, other: str, on: Expression, good: Expression,
    row_id: Expression = "id", unknown_ok: bool = True,
) -> Rule:
    """A condition on a row and its match in `other`, whose columns are named other_*.

    Rows without a match, or with NULL as the outcome, are good only if `unknown_ok`.
    """

    def find(t: Tables) -> DataFrame:
        match = t[other].select(*[F.col(c).alias(f"other_{c}") for c in t[other].columns])
        pairs = t[table].join(match, _column(on), "inner" if unknown_ok else "left")
        return pairs.filter(~F.coalesce(_column(good), F.lit(unknown_ok)))

    return Rule(name, "agreement", action, table, row_id, find=find)


def found_by(name: str, action: str, table: str, find: Callable[[Tables], DataFrame], row_id: Expression = "id") -> Rule:
    """Rows that an operator over several rows or tables returns."""
    return Rule(name, "several rows", action, table, row_id, find=find)


def run_rules(tables: Tables, rules: list[Rule]) -> DataFrame:
    """(rule, kind, action, table_name, row_id) of all violations."""

    def labels(r: Rule) -> list[Column]:
        values = {"rule": r.name, "kind": r.kind, "action": r.action, "table_name": r.table}
        return [F.lit(v).alias(k) for k, v in values.items()]

    parts, fused = [], {}
    for r in rules:
        if r.good is None:
            parts.append(r.find(tables).select(*labels(r), _column(r.row_id).cast("string").alias("row_id")))
        else:
            fused.setdefault((r.table, r.row_id), []).append(r)
    for (table, row_id), group in fused.items():
        broken = F.array_compact(F.array(*[F.when(~_column(r.good), F.struct(*labels(r))) for r in group]))
        parts.append(
            tables[table]
            .select(_column(row_id).cast("string").alias("row_id"), F.inline(broken))
            .select("rule", "kind", "action", "table_name", "row_id")
        )
    return union_all(*parts)


def rule_report(found: DataFrame, errors: DataFrame) -> DataFrame:
    """Distinct violations and how many of them the error log (table_name, row_id) explains."""
    log = errors.select("table_name", "row_id").distinct().withColumn("_hit", F.lit(1))
    rows = found.distinct().join(log, ["table_name", "row_id"], "left")
    return rows.groupBy("rule", "kind", "action").agg(
        F.count(F.lit(1)).alias("violations"),
        F.coalesce(F.sum("_hit"), F.lit(0)).alias("injected"),
    )
