"""Approximate matching without all pairs: every candidate comes from an equality on a derived key."""

from __future__ import annotations

from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.functions.predicates import as_col
from truegrain.functions.similarity import indel_matrix, indel_ratio
from truegrain.session import materialize


def _budget(a: Column, b: Column, cutoff: float) -> Column:
    """Insertions plus deletions two strings of these lengths may differ by at the cutoff."""
    return F.floor((a + b) * F.lit(1.0 - cutoff / 100.0) + F.lit(1e-9)).cast("int")


def _partner_lengths(length: Column, cutoff: float) -> Column:
    """Lengths a string can have and still reach the cutoff with one of `length`."""
    low = F.greatest(F.ceil(length * F.lit(cutoff / (200.0 - cutoff)) - F.lit(1e-9)), F.lit(1))
    high = F.greatest(F.floor(length * F.lit((200.0 - cutoff) / cutoff) + F.lit(1e-9)), F.lit(1))
    return F.sequence(low.cast("int"), high.cast("int"))


def candidates(values: DataFrame, value: str, names: DataFrame, name: str, cutoff: float) -> DataFrame:
    """Pairs (value, name) that can reach the cutoff. None is missed.

    With a budget of d insertions and deletions, cutting a name into d + 1 pieces leaves at least
    one piece untouched, so it occurs in the value. Pieces of the names meet the substrings of the
    values on (both lengths, piece). Below a cutoff of about 50 pieces vanish, so that is refused.
    """
    if cutoff <= 50:
        raise ValueError("cutoff must be above 50")
    n, v = F.col("_n"), F.col("_v")
    pieces = (
        names.select(name, F.length(name).alias("_n"))
        .filter(n > 0)
        .select(name, "_n", F.explode(_partner_lengths(n, cutoff)).alias("_v"))
        .withColumn("_k", F.least(_budget(n, v, cutoff) + 1, n))
        .select(name, "_n", "_v", "_k", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_i"))
    )
    start = F.floor(F.col("_i") * n / F.col("_k"))
    stop = F.floor((F.col("_i") + 1) * n / F.col("_k"))
    pieces = pieces.select(
        name, "_n", "_v", F.substr(F.col(name), start.cast("int") + 1, (stop - start).cast("int")).alias("_piece")
    ).distinct()
    sizes = (
        values.select(value, F.length(value).alias("_v"))
        .filter(v > 0)
        .select(value, "_v", F.explode(_partner_lengths(v, cutoff)).alias("_n"))
        .withColumn("_k", F.least(_budget(n, v, cutoff) + 1, n))
        # pieces have length floor or ceil of n / k
        .select(value, "_n", "_v", F.explode(F.array_distinct(F.array(
            F.floor(n / F.col("_k")).cast("int"), F.ceil(n / F.col("_k")).cast("int")))).alias("_size"))
        .filter(F.col("_size") <= v)
    )
    grams = sizes.select(
        value, "_n", "_v",
        F.explode(F.array_distinct(F.transform(
            F.sequence(F.lit(1), v - F.col("_size") + 1),
            lambda i: F.substr(F.col(value), i, F.col("_size")),
        ))).alias("_piece"),
    )
    return grams.join(pieces, ["_n", "_v", "_piece"]).select(value, name).distinct()


#: Names and values a task compares with each other at a time.
BLOCK = 2000
#: Bounds that `nearest` tries in turn where any similarity will do.
BOUNDS = (85.0, 65.0)


def _best(scored: DataFrame) -> DataFrame:
    """(_value, _best) of (_value, _name, _id, _score): the highest score, then the lowest id."""
    order = F.struct((-F.col("_score")).alias("s"), F.col("_id").alias("i"))
    return scored.groupBy("_value").agg(F.min_by(F.struct("_name", "_id", "_score"), order).alias("_best"))


def _best_within(keys: DataFrame, catalog: DataFrame, cutoff: float, scorer) -> DataFrame:
    pairs = candidates(keys, "_value", catalog.select("_key").distinct(), "_key", cutoff)
    scored = pairs.withColumn("_score", scorer(F.col("_value"), F.col("_key"))).filter(F.col("_score") >= cutoff)
    return _best(scored.join(catalog, "_key"))


def _best_in_blocks(keys: DataFrame, catalog: DataFrame) -> DataFrame:
    """Every value against every name, a block of each at a time; a value leaves a block with its best name only."""
    width = lambda df: max(1, -(-df.count() // BLOCK))
    rows, columns = width(keys), width(catalog)
    place = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = keys.select("_value", place("_value", rows).alias("_i"), every(columns).alias("_j"))
    known = catalog.select("_key", "_name", "_id", place("_key", columns).alias("_j"), every(rows).alias("_i"))
    schema = T.StructType(
        [T.StructField("_value", T.StringType()), *catalog.select("_name", "_id").schema, T.StructField("_score", T.DoubleType())]
    )

    def compare(values: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
        if values.empty or names.empty:
            return pd.DataFrame(columns=schema.names)
        names = names.sort_values("_id", kind="stable")
        scores = indel_matrix(values["_value"].tolist(), names["_key"].tolist())
        best = names.iloc[scores.argmax(axis=1)].reset_index(drop=True)
        return pd.DataFrame({"_value": values["_value"].array, "_name": best["_name"], "_id": best["_id"], "_score": scores.max(axis=1)})

    return _best(asked.groupBy("_i", "_j").cogroup(known.groupBy("_i", "_j")).applyInPandas(compare, schema))


def nearest(
    df: DataFrame, value: str, names: DataFrame, name: str, name_id: str, cutoff: float | None,
    normalize=None, scorer=indel_ratio,
) -> DataFrame:
    """Best name of each distinct value with similarity >= cutoff; the lowest id wins a tie.

    Values without such a name keep NULLs. `normalize` (a Column function, e.g. sorted tokens) is
    applied to both sides first. The scorer sees distinct candidate pairs only. With the usual scorer
    a value that is a name itself is settled first. Without a cutoff every value gets its best name, if
    there is any: falling bounds settle most values, the others are compared with all names in blocks.
    """
    if cutoff is None and scorer is not indel_ratio:
        raise ValueError("a scorer of your own needs a cutoff")
    tidy = normalize or (lambda c: as_col(c))
    values = df.select(F.col(value)).filter(F.col(value).isNotNull()).distinct().withColumn("_value", tidy(value))
    named = names.select(F.col(name).alias("_name"), F.col(name_id).alias("_id")).withColumn("_key", tidy("_name"))
    # of items that share a name only the lowest id can be the answer
    catalog = named.filter(F.col("_key").isNotNull()).groupBy("_key").agg(F.min_by("_name", "_id").alias("_name"), F.min("_id").alias("_id"))
    keys = values.select("_value").distinct()
    if scorer is not indel_ratio:
        best = _best_within(keys, catalog, cutoff, scorer)
    else:
        if cutoff is None:
            keys, catalog = materialize(keys, "entered"), materialize(catalog, "catalog")
        itself = F.struct("_name", "_id", F.lit(100.0).alias("_score")).alias("_best")
        best = keys.join(catalog, F.col("_value") == F.col("_key")).select("_value", itself)
        keys = keys.join(catalog.select(F.col("_key").alias("_value")), "_value", "left_anti")
        if cutoff is not None:
            best = best.unionByName(_best_within(keys, catalog, cutoff, scorer))
        else:
            for bound in BOUNDS:
                found = materialize(_best_within(keys, catalog, bound, scorer), "nearest")
                best = best.unionByName(found)
                keys = materialize(keys.join(found, "_value", "left_anti"), "entered")
            best = best.unionByName(_best_in_blocks(keys, catalog))
    return values.join(best, "_value", "left").select(
        value,
        F.col("_best._name").alias("best_name"),
        F.col("_best._id").alias("best_id"),
        F.col("_best._score").alias("similarity"),
    )


def nearest_token_sort(df, value, names, name, name_id, cutoff: float = 80.0) -> DataFrame:
    from truegrain.functions.similarity import sorted_tokens

    return nearest(df, value, names, name, name_id, cutoff, normalize=sorted_tokens)


def agreeing_tuples(
    rare: DataFrame, frequent: DataFrame, cols: list[str], max_differences: int = 2
) -> DataFrame:
    """Pairs of a rare and a frequent tuple that differ in at most `max_differences` columns.

    Such a pair agrees on some subset of the other columns. Each subset is a join key; a pair is
    kept only under its first agreeing subset, so no distinct is needed. `differs` names the
    columns to change; frequent columns come back as f_<column>.
    """
    subsets = list(combinations(range(len(cols)), len(cols) - max_differences))

    def keyed(df, rename):
        keys = F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(s).alias("subset"),
                        F.to_json(F.array(*[F.coalesce(F.col(cols[i]).cast("string"), F.lit("\u0000")) for i in subset])).alias("key"),
                    )
                    for s, subset in enumerate(subsets)
                ]
            )
        )
        out = df.withColumn("_b", keys).withColumn("_s", F.col("_b.subset")).withColumn("_key", F.col("_b.key")).drop("_b")
        for c in rename:
            out = out.withColumnRenamed(c, f"f_{c}")
        return out

    joined = keyed(rare, []).join(keyed(frequent, frequent.columns), ["_s", "_key"])
    same = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in cols]
    first = None
    for s, subset in enumerate(subsets):
        agrees = same[subset[0]]
        for i in subset[1:]:
            agrees = agrees & same[i]
        first = F.when(agrees, s) if first is None else first.when(agrees, s)
    differs = F.array_compact(F.array(*[F.when(~x, F.lit(c)) for x, c in zip(same, cols)]))
    return (
        joined.filter(F.col("_s") == first)
        .withColumn("differs", differs)
        .filter(F.size("differs").between(1, max_differences))
        .drop("_s", "_key")
    )
