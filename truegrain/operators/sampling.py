"""Top rows and reproducible samples. A sample depends on the key and a seed, never on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truegrain.operators.ranks import running, value_counts


def top_n(df: DataFrame, n: int, score: Column, *ties: str) -> DataFrame:
    return df.orderBy(score.desc(), *ties).limit(n)


def hash_order(*cols: str, seed: int = 0) -> Column:
    """Pseudo-random order of rows; md5 so that any engine can reproduce it."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def sample_n(df: DataFrame, n: int, *key: str, seed: int = 0) -> DataFrame:
    return df.orderBy(hash_order(*key, seed=seed), *key).limit(n)


def sample_fraction(df: DataFrame, fraction: float, *key: str, seed: int = 0) -> DataFrame:
    """Bernoulli sample by hash: a narrow filter without a shuffle."""
    slot = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in key]), F.lit(1_000_000))
    return df.filter(slot < F.lit(round(fraction * 1_000_000)))


def nested_subsets(df: DataFrame, unit: str, sizes: list[int], repeats: int = 3) -> DataFrame:
    """Growing subsets of whole units (days): the first n of a seeded permutation, several repeats.

    The permutation is over distinct units, so it is as small as a calendar.
    """
    units = df.select(unit).distinct()
    seeds = units.select(unit, F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat"))
    key = F.md5(F.concat_ws("|", F.col("repeat").cast("string"), F.col(unit).cast("string")))
    place = F.row_number().over(Window.partitionBy("repeat").orderBy(key, unit))
    chosen = seeds.withColumn("place", place).select(
        unit, "repeat", F.explode(F.array(*[F.lit(s) for s in sizes])).alias("size"), "place"
    )
    return df.join(chosen.filter(F.col("place") <= F.col("size")).drop("place"), unit)


def rank_table(df: DataFrame, score: str) -> DataFrame:
    """Rank of each distinct score, highest first, ties sharing the best rank."""
    counts = value_counts(df, [], score).withColumn("_down", -F.col(score))
    ranked = running(counts, [], "_down", {"upto": ("sum", "n")}, totals=True)
    return ranked.select(score, (F.col("upto") - F.col("n") + 1).alias("rank"), "n")


def top_share(df: DataFrame, share: float, score: str, row_id: str) -> DataFrame:
    """The best floor(share * n) rows by (score desc, id): a cut score on counts, then its ties."""
    counts = value_counts(df, [], score).withColumn("_down", -F.col(score))
    ranked = running(counts, [], "_down", {"upto": ("sum", "n")}, totals=True)
    want = F.floor(F.lit(share) * F.col("total_upto"))
    first = F.col("upto") - F.col("n")
    cut = ranked.filter((first < want) & (F.col("upto") >= want)).select(
        F.col(score).alias("cut"), (want - first).alias("need")
    )
    rows = df.withColumn("_edge", cut.select(F.struct("cut", "need")).scalar()).select(
        *df.columns, F.col("_edge.cut").alias("_cut"), F.col("_edge.need").alias("_need")
    )
    sure = rows.filter(F.col(score) > F.col("_cut"))
    tied = rows.filter(F.col(score) == F.col("_cut")).withColumn("_one", F.lit(1))
    placed = running(tied, [], row_id, {"_place": ("sum", "_one")})
    picked = placed.filter(F.col("_place") <= F.col("_need")).drop("_one", "_place")
    return sure.unionByName(picked).drop("_cut", "_need")


def examples_per_group(df: DataFrame, keys: list[str], value: str, n: int = 3) -> DataFrame:
    """The n smallest distinct values per group; each task keeps n rows per group before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(value))
    return df.select(*keys, value).distinct().withColumn("place", place).filter(F.col("place") <= n)
