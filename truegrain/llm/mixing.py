"""Mixing sources to target weights by repetition rates and hash-seeded draws (operator 1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truegrain.llm.common import WORD, carried
from truegrain.session import materialize

#: Seeds that a source can have.
TURNS = 32


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix") -> DataFrame:
    """`docs` with _size (words; null: 0), _source and _draw in [0, 1), which depends on seed and key only.

    A row without key draws by its text. Rows that repeat a key draw alike.
    """
    name = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("text:"), F.coalesce(F.col(text), F.lit(""))))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.withColumns({"_size": size, "_source": F.col(source), "_draw": draw})


def source_targets(sized: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(_from, _total, _target, _rate) for each source of rows of (_source, _size).

    Sources in code point order, null last, take the weights in turn. Together the targets are the sum
    of all sizes; none is over `most` times its source's size, and what is cut off goes to the others
    by weight. With the sources in order of size over weight, source i is cut if its limit is below
    its share of what the cut ones before it leave, so running sums settle it in one pass. The frame
    has one row a source (words are summed before the shuffle), which is all that meets in one task.
    A source without words has target and rate 0.
    """
    totals = sized.groupBy("_source").agg(F.sum("_size").alias("_total"))
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weighed = totals.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("double"))
    limit = F.lit(most) * F.col("_total").cast("double")
    everything = Window.partitionBy()
    ordered = Window.orderBy(F.col("_total").cast("double") / F.col("_weight"), F.col("_source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("_total").over(everything).cast("double") - F.lit(most) * F.coalesce(F.sum("_total").over(ordered), F.lit(0)).cast("double")
    open_weight = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(ordered), F.lit(0.0))
    cut = weighed.withColumn("_cut", limit * open_weight < left * F.col("_weight"))
    rest = F.sum("_total").over(everything).cast("double") - F.lit(most) * F.coalesce(F.sum(F.when(F.col("_cut"), F.col("_total"))).over(everything), F.lit(0)).cast("double")
    rest_weight = F.sum(F.when(~F.col("_cut"), F.col("_weight"))).over(everything)
    target = F.when(F.col("_cut"), limit).otherwise(F.col("_weight") * rest / rest_weight)
    rate = F.when(F.col("_total") > 0, F.col("_target") / F.col("_total")).otherwise(F.lit(0.0))
    return cut.withColumn("_target", target).withColumn("_rate", rate).select(F.col("_source").alias("_from"), "_total", "_target", "_rate")


def _extra(turn: Column) -> Column:
    """Whether a row's draw, turned by a constant around [0, 1), is under the fraction of its source's rate."""
    turned = F.col("_draw") + turn
    turned = turned - F.floor(turned)
    return F.when(turned < F.col("_rate") - F.floor("_rate"), 1).otherwise(0)


def seeded_targets(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Add _turn, a source's seed: of TURNS turns of the draws the one whose words come nearest its target.

    Each turn gives every document the same probability; a few long documents can take a single
    set of draws far from the target, and one of several sets comes near it. All sums are taken in one
    pass over narrow rows and combined before the shuffle.
    """
    joined = sized.join(targets, F.col("_source").eqNullSafe(F.col("_from")))
    taken = [F.sum(F.col("_size") * (F.floor("_rate") + _extra(F.lit(i / TURNS)))).alias(f"_t{i}") for i in range(TURNS)]
    sums = joined.groupBy("_from", "_target").agg(*taken)
    misses = [F.struct(F.abs(F.col(f"_t{i}") - F.col("_target")).alias("miss"), F.lit(i / TURNS).alias("turn")) for i in range(TURNS)]
    best = sums.select(F.col("_from").alias("_of"), F.least(*misses).getField("turn").alias("_turn"))
    return targets.join(best, F.col("_from").eqNullSafe(F.col("_of"))).drop("_of")


def mix(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Add _total, _target, _rate and _copies: floor(rate) copies and one more with the fraction's probability."""
    joined = sized.join(targets, F.col("_source").eqNullSafe(F.col("_from"))).drop("_from")
    return joined.withColumn("_copies", (F.floor("_rate") + _extra(F.col("_turn"))).cast("int"))


def planned(sized: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Targets, rates and seeds of the sources, written so that Spark knows how few rows they are."""
    targets = materialize(source_targets(sized, weights, most), "targets")
    return materialize(seeded_targets(sized, targets), "seeds")


def mix_report(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of every document.

    Texts are read once; the narrow sizes are written and serve both the totals and the result. Null
    texts have size 0 and take 0 words. Repeated rows count as documents of their own. An empty table
    gives no rows.
    """
    sized = materialize(measured(docs).select("doc_id", "_source", "_size", "_draw"), "sizes")
    rows = mix(sized, planned(sized, weights, most))
    return rows.select("doc_id", F.col("_size").alias("size"), F.col("_total").alias("source_size"), F.col("_target").alias("target"), F.col("_copies").alias("copies"), (F.col("_size") * F.col("_copies")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all columns of `docs`.

    Sizes and source plans are written first and few, so the texts are read twice and not shuffled. Null
    and blank texts have size 0; they are taken as often as their source's rate says. An empty table gives
    no rows.
    """
    sized = measured(carried(docs, "doc_id", "text", _of="source"), "_id", "_text", "_of")
    plan = planned(materialize(sized.select("_source", "_size", "_draw"), "sizes"), weights, most)
    copies = F.explode(F.array_repeat(F.lit(0), F.col("_copies"))).alias("_copy")
    return mix(sized, plan).select("_row", copies).select("_row.*")
