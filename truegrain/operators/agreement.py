"""The known tuple that most likely stands behind a rare one, without pairs of tuples.

A rare tuple and a known one that differ in a set of columns agree on the others, so both meet under
those columns' values. Where the differing columns have a constant similarity, every known tuple of
that key has the same odds but for its support: the key's support sum and its best-supported tuple
are all a rare tuple needs. Keys that hold tuples of fewer differences as well are set right by
inclusion and exclusion. Where a differing column is compared as text, the same holds for each of the
key's texts: blocks of its distinct texts are compared in the tasks, and one row a rare text and block
leaves them.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.functions.similarity import indel_matrix, indel_percent
from truegrain.session import materialize

#: Known and rare texts of one key that a task compares at a time, and rows a task call gets.
BLOCK = 2000
LEAST = 0.01


def tuple_key(cols: list[str]) -> Column:
    """Text that tells tuples apart, NULL included; columns hold text."""
    return F.to_json(F.array(*[F.array(F.col(c).isNull().cast("string"), F.coalesce(c, F.lit(""))) for c in cols]))


def _keyed(df: DataFrame, cols: list[str], sets: dict[int, tuple[int, ...]]) -> DataFrame:
    """One row per set of differing columns, under the values of the other columns."""
    keys = []
    for s, differing in sets.items():
        shared = [c for i, c in enumerate(cols) if i not in differing]
        keys.append(F.struct(F.lit(s).alias("s"), (tuple_key(shared) if shared else F.lit("")).alias("key")))
    return df.withColumn("_k", F.explode(F.array(*keys))).withColumn("_s", F.col("_k.s")).withColumn("_key", F.col("_k.key")).drop("_k")


def _meet(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join by shuffle. The files of stored tuples tell little of the rows that keys make of them, so the
    byte threshold would send tables to the driver that are many times its size."""
    return left.join(right.hint("merge"), on)


def pair_rows(rare: DataFrame, known: DataFrame, cols: list[str], max_differences: int = 2) -> int:
    """Rows of a join of the tuples under the values of all columns but `max_differences`."""
    sets = dict(enumerate(combinations(range(len(cols)), min(max_differences, len(cols)))))
    counted = lambda df, n: _keyed(df.select(*cols), cols, sets).groupBy("_s", "_key").agg(F.count(F.lit(1)).alias(n))
    return counted(rare, "_i").join(counted(known, "_j"), ["_s", "_key"]).agg(F.sum(F.col("_i") * F.col("_j"))).first()[0] or 0


def _weights(sets: dict[int, tuple[int, ...]], odds) -> dict[int, float]:
    """What a unit of support under each set's key adds to the total of all odds.

    The support that differs in exactly the set's columns is an alternating sum over its subsets.
    """
    out = dict.fromkeys(sets, 0.0)
    for differing in sets.values():
        for t, part in sets.items():
            if set(part) <= set(differing):
                out[t] += (-1) ** (len(differing) - len(part)) * odds(differing)
    return out


def _pair_similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of the texts of two columns of pairs, each pair of texts compared once; NULL is empty."""
    blank = lambda values: pd.factorize(np.array(["" if v is None else v for v in values], dtype=object))
    (i, left), (j, right) = blank(a[0]), blank(b[0])
    if len(left) * len(right) <= len(a[1]):
        return indel_matrix(list(left), list(right))[i[a[1]], j[b[1]]] / 100
    both, back = np.unique(i[a[1]] * len(right) + j[b[1]], return_inverse=True)
    return np.array([indel_percent(left[n // len(right)], right[n % len(right)]) for n in both])[back] / 100


def _compare(cols, sets, similarity, eps):
    """Cogrouped values of rare and known tuples: per rare value and key the odds of the known ones and the best tuple.

    The odds are those of the texts alone, `logp` counts every column of the set as different.
    """
    block = ["_s", "_key", "_i", "_j"]
    names = ["_s", "_key", "_v", "z", "logp", *cols]
    same = math.log(1 - eps)

    def compare(rare: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        # known rows in the order of their keys: those of a rare row's key are neighbours
        codes = pd.concat([rare[block], known[block]]).groupby(block, sort=False).ngroup().to_numpy()
        mine, theirs = codes[: len(rare)], codes[len(rare) :]
        order = np.argsort(theirs, kind="stable")
        known, theirs = known.iloc[order], theirs[order]
        start = np.searchsorted(theirs, mine)
        count = np.searchsorted(theirs, mine, side="right") - start
        rare, start, count = rare[count > 0], start[count > 0], count[count > 0]
        if rare.empty:
            return pd.DataFrame(columns=names)
        first = np.cumsum(count) - count
        r = np.repeat(np.arange(len(rare)), count)
        k = np.arange(len(r)) - first[r] + start[r]
        support = known["support"].to_numpy("float64")
        set_of = rare["_s"].to_numpy()[r]
        logp, odds, open_ = np.log(support)[k], known["_n"].to_numpy("float64")[k], np.ones(len(r), dtype=bool)
        for i, c in enumerate(cols):
            apart = np.isin(set_of, [s for s, differing in sets.items() if i in differing])
            step = np.full(len(r), same)
            if similarity[c] is not None:
                step[apart] = math.log(eps * similarity[c])
            elif apart.any():
                a, b = rare[c].to_numpy(object), known[f"known_{c}"].to_numpy(object)
                at = np.flatnonzero(apart)
                open_[at] &= a[r[at]] != b[k[at]]
                alike = eps * np.maximum(_pair_similarity((a, r[at]), (b, k[at])), LEAST)
                step[at] = np.log(alike)
                odds[at] *= alike
            logp += step
        top = np.maximum.reduceat(np.where(open_, logp, -np.inf), first)
        held = [known[f"known_{c}"].to_numpy(object) for c in cols]
        rank = np.empty(len(known), dtype=np.int64)
        rank[sorted(range(len(known)), key=lambda n: tuple((v[n] is not None, v[n] or "") for v in held))] = np.arange(len(known))
        best = np.maximum.reduceat(np.where(open_ & (logp == top[r]), rank[k], -1), first)
        found, at = best >= 0, np.argsort(rank)[best]
        z = np.add.reduceat(np.where(open_, odds, 0.0), first)
        out = [*(rare[c].to_numpy(object) for c in ("_s", "_key", "_v")), z, top, *(v[at] for v in held)]
        return pd.DataFrame({n: v[found] for n, v in zip(names, out)})

    return compare


def _text_rows(rare, known, cols, sets, similarity, eps) -> DataFrame:
    """(_r, z, logp, to) from tuples that differ in one of `sets`, in every column that is compared as text.

    Under a key, tuples with the same texts in these columns are compared once: the known ones by their support
    sum and their best-supported tuple, which stands for tuples that agree in a column of constant similarity
    as well; their odds are better under a smaller set, and the weights take them out of this set's sum.
    """
    text = {s: tuple(i for i in d if similarity[cols[i]] is None) for s, d in sets.items()}
    value = F.coalesce(*[F.when(F.col("_s") == s, tuple_key([cols[i] for i in d])) for s, d in text.items()])
    keyed = lambda df: _keyed(df, cols, sets).withColumn("_v", value).groupBy("_s", "_key", "_v")
    known = materialize(keyed(known).agg(F.sum("support").alias("_n"), F.max(F.struct("support", F.struct(*cols).alias("to"))).alias("_t")), "known")
    values = materialize(keyed(rare).agg(F.first(F.struct(*cols)).alias("_t")), "rare")
    blocks = lambda df, name: df.groupBy("_s", "_key").agg(F.count(F.lit(1)).alias(name))
    plan = materialize(_meet(blocks(values, "_ni"), blocks(known, "_nj"), ["_s", "_key"]), "agreement")
    calls = -(-(plan.agg(F.sum(F.col("_ni") + F.col("_nj"))).first()[0] or 1) // BLOCK)
    pieces = lambda n: F.ceil(F.col(n) / BLOCK).cast("int").alias(n)
    plan = plan.select("_s", "_key", pieces("_ni"), pieces("_nj"))
    place = lambda n: F.pmod(F.xxhash64("_v"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = _meet(values, plan, ["_s", "_key"]).withColumn("_i", place("_ni")).withColumn("_j", every("_nj"))
    right = _meet(known, plan, ["_s", "_key"]).withColumn("_j", place("_nj")).withColumn("_i", every("_ni"))
    # small keys share a call, a block of a large key fills one
    spread = F.when((F.col("_ni") > 1) | (F.col("_nj") > 1), F.xxhash64("_s", "_key", "_i", "_j")).otherwise(
        F.pmod(F.xxhash64("_s", "_key"), F.lit(calls))
    )
    schema = T.StructType(
        [T.StructField("_s", T.IntegerType()), T.StructField("_key", T.StringType()), T.StructField("_v", T.StringType())]
        + [T.StructField("z", T.DoubleType()), T.StructField("logp", T.DoubleType())]
        + [T.StructField(c, T.StringType()) for c in cols]
    )
    keep = ["_s", "_key", "_i", "_j", "_call"]
    left = left.withColumn("_call", spread).select("_v", *[F.col(f"_t.{c}").alias(c) for c in cols], *keep)
    right = right.withColumn("_call", spread).select("_n", "_t.support", *[F.col(f"_t.to.{c}").alias(f"known_{c}") for c in cols], *keep)
    found = left.groupBy("_call").cogroup(right.groupBy("_call")).applyInPandas(_compare(cols, sets, similarity, eps), schema)
    found = found.groupBy("_s", "_key", "_v").agg(F.sum("z").alias("z"), F.max(F.struct("logp", F.struct(*cols).alias("to"))).alias("_b"))
    weights = {}
    for compared in set(text.values()):
        alike = {s: d for s, d in sets.items() if text[s] == compared}
        rest = lambda d: [similarity[cols[i]] for i in d if similarity[cols[i]] is not None]
        weights |= _weights(alike, lambda d: (1 - eps) ** (len(cols) - len(d)) * math.prod(eps * x for x in rest(d)))
    weight = F.element_at(F.create_map(*[F.lit(x) for s, w in weights.items() for x in (s, w)]), F.col("_s"))
    met = _meet(_keyed(rare, cols, sets).withColumn("_v", value).select("_r", "_s", "_key", "_v"), found, ["_s", "_key", "_v"])
    return met.select("_r", (weight * F.col("z")).alias("z"), "_b.logp", "_b.to")


def most_probable(
    rare: DataFrame, known: DataFrame, cols: list[str], similarity: dict[str, float | None], eps: float, max_differences: int = 2,
    digits: int = 12,
) -> DataFrame:
    """(_r, _best, p): per rare tuple the most probable known one at most `max_differences` columns away.

    `rare` holds distinct text tuples that are not known, `known` those with their `support`. The odds of
    a known tuple are its support times 1 - eps per equal column and eps * similarity per other one, the
    similarity being the column's constant or, for None, that of the texts (0.01 at least); p is its share
    of all odds. NULLs are equal. Ties go to the largest tuple, column by column. Rare tuples without a
    known one within reach have no row.
    """
    if not 0 < eps <= 0.5:
        raise ValueError("eps must be in (0, 0.5]: a tuple of fewer differences must have the better odds")
    k = len(cols)
    every = [c for n in range(1, min(max_differences, k) + 1) for c in combinations(range(k), n)]
    fixed = {s: d for s, d in enumerate(every) if all(similarity[cols[i]] is not None for i in d)}
    text = {s: d for s, d in enumerate(every) if s not in fixed}
    rare = rare.select(*cols).withColumn("_r", tuple_key(cols))
    known = known.select(*cols, "support")
    parts = []
    if fixed:
        weights = _weights(fixed, lambda d: (1 - eps) ** (k - len(d)) * math.prod(eps * similarity[cols[i]] for i in d))
        weight = F.element_at(F.create_map(*[F.lit(x) for s, w in weights.items() for x in (s, w)]), F.col("_s"))
        sums = _keyed(known, cols, fixed).groupBy("_s", "_key").agg(
            F.sum("support").alias("_n"), F.max(F.struct("support", F.struct(*cols).alias("to"))).alias("_t")
        )
        met = _meet(_keyed(rare, cols, fixed), sums, ["_s", "_key"])
        logp = F.log(F.col("_t.support").cast("double"))
        for c in cols:
            other = F.lit(None).cast("double") if similarity[c] is None else F.log(F.lit(eps) * F.lit(similarity[c]))
            logp = logp + F.when(F.col(c).eqNullSafe(F.col(f"_t.to.{c}")), F.lit(math.log(1 - eps))).otherwise(other)
        parts.append(met.select("_r", (weight * F.col("_n")).alias("z"), logp.alias("logp"), F.col("_t.to").alias("to")))
    if text:
        parts.append(_text_rows(rare, known, cols, text, similarity, eps))
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    best = found.groupBy("_r").agg(F.sum("z").alias("_z"), F.max(F.struct("logp", "to")).alias("_b"))
    # rounded: shares of equal odds come out the same in any order of summation
    p = F.least(F.round(F.exp("_b.logp") / F.col("_z"), digits), F.lit(1.0))
    return best.select("_r", F.col("_b.to").alias("_best"), p.alias("p"))
