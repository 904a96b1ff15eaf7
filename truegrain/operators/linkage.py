"""Probabilistic record linkage (Fellegi-Sunter) of near-duplicate records.

Identical records are folded into profiles first: a group of copies is one profile with a count,
never a set of pairs. Profiles are compared only where an equality on (block, day, amount band)
brings them together. Pairs whose amounts are far apart are never built: their number follows from
group sizes, and they are below any useful threshold. If parameters say otherwise, they are built
on (block, day) instead, so nothing is lost.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.operators.ranks import running
from truegrain.session import materialize


@dataclass(frozen=True)
class LinkSpec:
    """Columns of a record: `block` must agree, days may differ by `max_days`, amounts by a share."""

    row_id: str
    block: tuple[str, ...]
    day: str
    amount: str
    exact: str
    max_days: int = 3
    near_share: float = 0.15


# The m-probabilities that are set and not trained, and the assumed recall of the rule
# that estimates the prior. Day levels are: same, 1 day, up to max_days, further.
BLOCK_M = 0.999
DAY_M = (0.95, 0.04, 0.005, 0.005)
RULE_RECALL = 0.9


@dataclass
class LinkModel:
    prior: float
    block_u: float
    day_u: tuple[float, ...]
    amount_u: tuple[float, float, float]
    exact_u: float
    amount_m: tuple[float, float, float] = (0.8, 0.15, 0.05)
    exact_m: float = 0.9
    history: list = field(default_factory=list)

    def weight(self, day_level: int, amount_level: int | None, exact: bool | None) -> float:
        """Match odds of a gamma pattern; a level of None is neutral (a value is missing)."""
        odds = self.prior / (1 - self.prior) * BLOCK_M / max(self.block_u, 1e-12)
        odds *= DAY_M[day_level] / max(self.day_u[day_level], 1e-12)
        if amount_level is not None:
            odds *= self.amount_m[amount_level] / max(self.amount_u[amount_level], 1e-12)
        if exact is not None:
            m, u = (self.exact_m, self.exact_u) if exact else (1 - self.exact_m, 1 - self.exact_u)
            odds *= m / max(u, 1e-12)
        return odds

    def probability(self, day_level, amount_level, exact) -> float:
        w = self.weight(day_level, amount_level, exact)
        return w / (1 + w)


def profiles(df: DataFrame, s: LinkSpec) -> DataFrame:
    """Distinct records with their count and lowest id."""
    day = F.col(s.day).cast("date").alias("day")
    return df.filter(F.col(s.day).isNotNull()).groupBy(
        *s.block, day, F.col(s.amount).cast("double").alias("amount"), F.col(s.exact).alias("exact")
    ).agg(F.count(F.lit(1)).alias("n"), F.min(s.row_id).alias("first_id"))


def _band(amount: Column, share: float) -> Column:
    """Geometric band of an amount: near amounts share a band or sit in neighbouring ones."""
    size = F.floor(F.log(F.abs(amount)) / F.lit(-math.log(1 - share)))
    return F.when(amount == 0, F.lit("0")).otherwise(
        F.concat(F.when(amount < 0, "-").otherwise("+"), size.cast("string"))
    )


def _near(a: Column, b: Column, share: float) -> Column:
    top = F.greatest(F.abs(a), F.abs(b))
    return F.coalesce(F.abs(a - b) / F.nullif(top, F.lit(0.0)) < share, F.lit(False)) & (a != b)


def candidate_pairs(p: DataFrame, s: LinkSpec, max_days: int | None = None, all_amounts: bool = False) -> DataFrame:
    """Pairs of different profiles in one block, at most max_days apart, with near or equal amounts.

    The later (or, on one day, the higher) profile looks back: it names the days and bands it can
    meet and joins on equality. Profiles without an amount meet every profile of the day.
    """
    days = s.max_days if max_days is None else max_days
    order = F.struct("day", "first_id")
    left = p.select(
        *s.block, F.col("day").alias("day_l"), F.col("amount").alias("amount_l"), F.col("exact").alias("exact_l"),
        F.col("n").alias("n_l"), F.col("first_id").alias("id_l"), order.alias("_order_l"),
    )
    right = p.select(
        *s.block, F.col("day").alias("day_r"), F.col("amount").alias("amount_r"), F.col("exact").alias("exact_r"),
        F.col("n").alias("n_r"), F.col("first_id").alias("id_r"), order.alias("_order_r"),
    ).withColumn("_back", F.explode(F.sequence(F.lit(0), F.lit(days)))).withColumn(
        "_day", F.date_sub("day_r", F.col("_back"))
    )
    left = left.withColumn("_day", F.col("day_l"))
    keys = [*s.block, "_day"]
    if all_amounts:
        return left.join(right, keys).filter(F.col("_order_l") < F.col("_order_r")).drop("_day", "_back", "_order_l", "_order_r")
    signed = lambda a, k: F.when(a == 0, F.lit("0")).otherwise(
        F.concat(F.when(a < 0, "-").otherwise("+"),
                 (F.floor(F.log(F.abs(a)) / F.lit(-math.log(1 - s.near_share))) + k).cast("string"))
    )
    a_l, a_r = F.col("amount_l"), F.col("amount_r")
    with_band = left.filter(a_l.isNotNull()).withColumn("_band", _band(a_l, s.near_share))
    reach = F.array_distinct(F.array(*[signed(a_r, k) for k in (-1, 0, 1)]))
    meets = right.filter(a_r.isNotNull()).withColumn("_band", F.explode(reach))
    close = with_band.join(meets, [*keys, "_band"]).filter(
        (a_l == a_r) | _near(a_l, a_r, s.near_share)
    ).drop("_band")
    empty_right = left.join(right.filter(a_r.isNull()), keys)
    empty_left = left.filter(a_l.isNull()).join(right.filter(a_r.isNotNull()), keys)
    return (
        close.unionByName(empty_right).unionByName(empty_left)
        .filter(F.col("_order_l") < F.col("_order_r"))
        .drop("_day", "_back", "_order_l", "_order_r")
    )


def gammas(pairs: DataFrame, s: LinkSpec) -> DataFrame:
    """Comparison levels: day_level 0 same, 1 one day, 2 further; amount_level 0 equal, 1 near,
    2 else, NULL missing; same_exact, NULL missing."""
    gap = F.abs(F.datediff("day_l", "day_r"))
    a, b = F.col("amount_l"), F.col("amount_r")
    return (
        pairs.withColumn("day_level", F.when(gap == 0, 0).when(gap <= 1, 1).when(gap <= s.max_days, 2).otherwise(3))
        .withColumn(
            "amount_level",
            F.when(a.isNull() | b.isNull(), None).when(a == b, 0).when(_near(a, b, s.near_share), 1).otherwise(2),
        )
        .withColumn("same_exact", F.col("exact_l") == F.col("exact_r"))
    )


def _pairs_of(n: Column) -> Column:
    n = n.cast("double")
    return n * (n - 1) / 2


def pattern_counts(df: DataFrame, p: DataFrame, s: LinkSpec) -> dict[tuple, float]:
    """Number of pairs per (amount_level, same_exact) inside the training block (block, same day).

    Equal and near pairs are counted from profile pairs, copies from profile counts, and the rest
    from group sizes, so the far pairs are counted without being built.
    """
    block = [*s.block, "day"]
    near = gammas(candidate_pairs(p, s, max_days=0), s)
    counted = {
        (r["amount_level"], r["same_exact"]): r["pairs"]
        for r in near.groupBy("amount_level", "same_exact").agg(
            F.sum(F.col("n_l").cast("double") * F.col("n_r")).alias("pairs")
        ).collect()
    }
    copies = p.agg(
        F.sum(F.when(F.col("amount").isNotNull() & F.col("exact").isNotNull(), _pairs_of(F.col("n")))).alias("full"),
        F.sum(F.when(F.col("amount").isNull() & F.col("exact").isNotNull(), _pairs_of(F.col("n")))).alias("no_amount"),
        F.sum(F.when(F.col("amount").isNotNull() & F.col("exact").isNull(), _pairs_of(F.col("n")))).alias("no_exact"),
    ).first()
    for key, value in (((0, True), copies["full"]), ((None, True), copies["no_amount"]), ((0, None), copies["no_exact"])):
        counted[key] = counted.get(key, 0.0) + (value or 0.0)
    sized = p.groupBy(*block, "exact").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("amount").isNotNull(), F.col("n")).otherwise(0)).alias("v")
    )
    same = sized.filter(F.col("exact").isNotNull()).agg(F.sum(_pairs_of(F.col("v")))).first()[0] or 0.0
    per_block = sized.filter(F.col("exact").isNotNull()).groupBy(*block).agg(F.sum("v").alias("v"))
    both = per_block.agg(F.sum(_pairs_of(F.col("v")))).first()[0] or 0.0
    near_same = counted.get((0, True), 0.0) + counted.get((1, True), 0.0)
    near_other = counted.get((0, False), 0.0) + counted.get((1, False), 0.0)
    counted[(2, True)] = max(same - near_same, 0.0)
    counted[(2, False)] = max(both - same - near_other, 0.0)
    return counted


def expectation_step(model: LinkModel, patterns: dict[tuple, float]) -> LinkModel:
    """One EM step on pattern counts. Block and day are fixed by the training block, so the prior
    inside it starts from the odds they give."""
    total = matched = 0.0
    amount, exact = [0.0, 0.0, 0.0], 0.0
    with_amount = with_exact = 0.0
    for (level, same), count in patterns.items():
        p = model.probability(0, level, same)
        total += count
        matched += p * count
        if level is not None:
            amount[level] += p * count
            with_amount += p * count
        if same is not None:
            exact += p * count * (1.0 if same else 0.0)
            with_exact += p * count
    if matched <= 0:
        return model
    floor = 1e-6
    share = [max(a / with_amount, floor) for a in amount] if with_amount else list(model.amount_m)
    scale = sum(share)
    return LinkModel(
        model.prior, model.block_u, model.day_u, model.amount_u, model.exact_u,
        tuple(a / scale for a in share),
        min(max(exact / with_exact, floor), 1 - floor) if with_exact else model.exact_m,
        [*model.history, matched],
    )


def _collision(df: DataFrame, columns: list[str], weight: str | None = None) -> float:
    """Probability that two random rows agree on the columns, from group sizes."""
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    groups = df.groupBy(*columns).agg(size.alias("n"))
    row = groups.agg(F.sum("n").alias("all"), F.sum(_pairs_of(F.col("n"))).alias("same")).first()
    whole = row["all"] * (row["all"] - 1) / 2 if row["all"] else 0
    return float(row["same"] / whole) if whole else 0.0


def _near_share_of_pairs(p: DataFrame, s: LinkSpec) -> float:
    """Probability that two random rows have near but different amounts, without pairs: each amount
    asks how many rows lie in its lower neighbourhood, by running counts over amounts and limits."""
    counts = p.filter(F.col("amount").isNotNull()).groupBy("amount").agg(F.sum("n").alias("n"))
    a = F.col("amount")
    # partners b below a with (a - b) / max(|a|, |b|) < share: b > a(1 - share) for a > 0, b > a / (1 - share) for a < 0
    limit = F.when(a > 0, a * F.lit(1 - s.near_share)).otherwise(a / F.lit(1 - s.near_share))
    asks = counts.select(limit.alias("at"), F.lit(0).cast("bigint").alias("n"), a.alias("asker"), F.col("n").alias("w"))
    own = counts.select(a.alias("at"), "n", F.lit(None).cast("double").alias("asker"), F.lit(0).cast("bigint").alias("w"))
    # at one value the amounts count before the limits ask: limits exclude rows exactly on them
    line = own.unionByName(asks).groupBy("at").agg(
        F.sum("n").alias("n"), F.collect_list(F.when(F.col("asker").isNotNull(), F.struct("asker", "w"))).alias("asks")
    )
    ranked = running(line, [], "at", {"upto": ("sum", "n")})
    below = ranked.select(F.explode("asks").alias("q"), "upto").select(F.col("q.asker").alias("at"), F.col("q.w").alias("w"), "upto")
    own_rank = ranked.filter(F.col("n") > 0).select("at", F.col("upto").alias("self"), F.col("n").alias("own"))
    pairs = below.join(own_rank, "at").select(
        (F.col("w").cast("double") * F.greatest(F.col("self") - F.col("own") - F.col("upto"), F.lit(0))).alias("c")
    )
    found = pairs.agg(F.sum("c")).first()[0] or 0.0
    rows = counts.agg(F.sum("n")).first()[0] or 0
    whole = rows * (rows - 1) / 2
    return float(found / whole) if whole else 0.0


def _day_u(p: DataFrame, s: LinkSpec) -> tuple[float, ...]:
    """Shares of random pairs per day gap, from the day histogram (one row per calendar day)."""
    per_day = p.groupBy("day").agg(F.sum("n").alias("n"))
    shifted = per_day.select("n", F.explode(F.sequence(F.lit(0), F.lit(s.max_days))).alias("gap"), "day").withColumn(
        "day", F.date_add("day", F.col("gap"))
    ).withColumnRenamed("n", "m")
    joined = shifted.join(per_day, "day").groupBy("gap").agg(
        F.sum(F.when(F.col("gap") == 0, _pairs_of(F.col("n"))).otherwise(F.col("n").cast("double") * F.col("m"))).alias("c")
    )
    found = {r["gap"]: r["c"] for r in joined.collect()}
    rows = per_day.agg(F.sum("n")).first()[0] or 0
    whole = max(rows * (rows - 1) / 2, 1)
    same, one = found.get(0, 0.0), found.get(1, 0.0)
    some = sum(v for g, v in found.items() if g > 1)
    return tuple(x / whole for x in (same, one, some, max(whole - same - one - some, 0.0)))


def train(df: DataFrame, s: LinkSpec, steps: int = 25) -> tuple[LinkModel, DataFrame]:
    """(model, profiles). Everything that reaches the driver is a handful of sums."""
    p = materialize(profiles(df, s), "profiles")
    rows = p.agg(F.sum("n")).first()[0] or 0
    whole = max(rows * (rows - 1) / 2, 1)
    block = p.groupBy(*s.block, "day").agg(F.sum("n").alias("n"))
    rule = block.agg(F.sum(_pairs_of(F.col("n")))).first()[0] or 0.0
    equal = _collision(p.filter(F.col("amount").isNotNull()), ["amount"], "n")
    near = _near_share_of_pairs(p, s)
    model = LinkModel(
        prior=min(max(rule / RULE_RECALL / whole, 1e-12), 0.5),
        block_u=_collision(p, list(s.block), "n"),
        day_u=_day_u(p, s),
        amount_u=(equal, near, max(1 - equal - near, 1e-12)),
        exact_u=_collision(p.filter(F.col("exact").isNotNull()), ["exact"], "n"),
    )
    patterns = pattern_counts(df, p, s)
    for _ in range(steps):
        model = expectation_step(model, patterns)
    return model, p


def score_pairs(p: DataFrame, s: LinkSpec, model: LinkModel, threshold: float = 0.01) -> DataFrame:
    """Pairs of profiles at or above the threshold, with n_l and n_r copies behind each side, and
    the copies inside one profile as a pair of the profile with itself (n_l = n_r = copies)."""
    far_matters = any(
        model.probability(d, 2, e) >= threshold for d in range(3) for e in (True, False, None)
    )
    pairs = gammas(candidate_pairs(p, s, all_amounts=far_matters), s)
    selves = p.filter(F.col("n") > 1)
    twins = gammas(
        selves.select(
            *s.block, F.col("day").alias("day_l"), F.col("day").alias("day_r"),
            F.col("amount").alias("amount_l"), F.col("amount").alias("amount_r"),
            F.col("exact").alias("exact_l"), F.col("exact").alias("exact_r"),
            F.col("n").alias("n_l"), F.col("n").alias("n_r"),
            F.col("first_id").alias("id_l"), F.col("first_id").alias("id_r"),
        ),
        s,
    )
    table = [
        (d, a, e, model.probability(d, a, e)) for d in range(4) for a in (0, 1, 2, None) for e in (True, False, None)
    ]
    weights = p.sparkSession.createDataFrame(table, "_d int, _a int, _e boolean, probability double")
    on = (
        F.col("day_level").eqNullSafe(F.col("_d")) & F.col("amount_level").eqNullSafe(F.col("_a"))
        & F.col("same_exact").eqNullSafe(F.col("_e"))
    )
    scored = pairs.unionByName(twins).join(F.broadcast(weights), on).drop("_d", "_a", "_e")
    return scored.filter(F.col("probability") >= threshold)


def linked_row_pairs(scored: DataFrame) -> DataFrame:
    """How many pairs of rows each linked pair of profiles stands for."""
    twins = F.col("id_l") == F.col("id_r")
    return scored.withColumn(
        "row_pairs", F.when(twins, _pairs_of(F.col("n_l"))).otherwise(F.col("n_l").cast("double") * F.col("n_r"))
    )


def members(df: DataFrame, s: LinkSpec, p: DataFrame) -> DataFrame:
    """(profile id, row id): the rows behind the profiles, to expand a linked pair where needed."""
    day = F.col(s.day).cast("date")
    rows = df.select(
        F.col(s.row_id), *s.block, day.alias("day"), F.col(s.amount).cast("double").alias("amount"), F.col(s.exact).alias("exact")
    )
    keys = [*s.block, "day", "amount", "exact"]
    right = p.select(*[F.col(k).alias(f"_{k}") for k in keys], "first_id")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(right, on).select(F.col("first_id").alias("profile_id"), F.col(s.row_id))


def exact_duplicates(df: DataFrame, row_id: str, cols: list[str]) -> DataFrame:
    """Baseline: per group of equal rows the two lowest ids and the size of the group."""
    groups = df.groupBy(*cols).agg(F.min(row_id).alias("id_l"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    right = groups.select(*[F.col(c).alias(f"_{c}") for c in cols], "id_l", "rows")
    on = F.lit(True)
    for c in cols:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    others = df.join(right, on).filter(F.col(row_id) > F.col("id_l"))
    return others.groupBy("id_l", "rows").agg(F.min(row_id).alias("id_r")).select("id_l", "id_r", "rows")


def pair_quality(scored: DataFrame, truth: DataFrame, thresholds, members: DataFrame, row_id: str) -> DataFrame:
    """Found and right row pairs per threshold, with precision and recall.

    `scored` has pairs of profiles (id_l, id_r, probability), `members` the rows (profile_id, row) of
    each profile and `truth` true row pairs (id_l, id_r) in either order. Rows of one profile are found at any
    threshold, whether or not `scored` pairs the profile with itself. Found pairs are counted from the sizes of profiles, never built.
    """
    sizes = members.groupBy("profile_id").agg(F.count(F.lit(1)).alias("n"))
    left = sizes.select(F.col("profile_id").alias("id_l"), F.col("n").alias("n_l"))
    right = sizes.select(F.col("profile_id").alias("id_r"), F.col("n").alias("n_r"))
    pairs = scored.select(F.least("id_l", "id_r").alias("id_l"), F.greatest("id_l", "id_r").alias("id_r"), "probability").filter("id_l < id_r")
    of_l = members.select(F.col(row_id).alias("id_l"), F.col("profile_id").alias("_pl"))
    of_r = members.select(F.col(row_id).alias("id_r"), F.col("profile_id").alias("_pr"))
    known = truth.select(F.least("id_l", "id_r").alias("id_l"), F.greatest("id_l", "id_r").alias("id_r")).filter("id_l < id_r").distinct()
    placed = known.join(of_l, "id_l", "left").join(of_r, "id_r", "left").select(
        F.least("_pl", "_pr").alias("id_l"), F.greatest("_pl", "_pr").alias("id_r"), (F.col("_pl") == F.col("_pr")).alias("_same")
    )
    true_pairs = placed.filter(~F.coalesce("_same", F.lit(False))).groupBy("id_l", "id_r").agg(F.count(F.lit(1)).alias("t"))
    inside = sizes.agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0.0)).cast("long")).scalar()
    inside_true = placed.agg(F.count_if("_same")).scalar()
    all_true = known.agg(F.count(F.lit(1))).scalar()
    marked = pairs.join(left, "id_l").join(right, "id_r").join(true_pairs, ["id_l", "id_r"], "left")
    counted = marked.select("probability", (F.col("n_l") * F.col("n_r")).alias("n"), F.coalesce("t", F.lit(0)).alias("t"))
    steps = F.array(*[F.lit(float(t)) for t in thresholds])
    above = counted.select("n", "t", F.explode(F.filter(steps, lambda t: F.col("probability") >= t)).alias("threshold"))
    none = scored.sparkSession.range(1).select(F.lit(0).alias("n"), F.lit(0).alias("t"), F.explode(steps).alias("threshold"))
    met = above.unionByName(none).groupBy("threshold").agg(F.sum("n").alias("_n"), F.sum("t").alias("_t"))
    out = met.select("threshold", (F.col("_n") + inside).alias("found"), (F.col("_t") + inside_true).alias("right"), all_true.alias("_all"))
    return out.withColumn("precision", F.col("right") / F.nullif(F.col("found"), F.lit(0))).withColumn(
        "recall", F.col("right") / F.nullif(F.col("_all"), F.lit(0))
    ).drop("_all")
