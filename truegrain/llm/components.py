"""Connected components of links between 64-bit nodes, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.session import materialize


def _stars(pairs: DataFrame) -> DataFrame:
    """pairs (u, v): each v above u, and u itself, is tied to the least node that u knows."""
    least = materialize(pairs.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m")), "least")
    known = least.withColumnRenamed("u", "w")
    return pairs.join(known, F.col("u") == F.col("w")).select("u", "v", "m")


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b) that is not itself a root; the root is the least node.

    A round ties the larger neighbours of a node to its least neighbour, then the smaller ones; the
    number of rounds grows with the logarithm of the longest chain. Every round is written to the
    shared folder, so a lost executor costs one round at most. A node with very many links only meets
    its own minimum in a join that adaptive execution can split.
    """
    tidy = links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).filter("high > low")
    edges = materialize(tidy.distinct(), "edges")
    state = _summary(edges)
    while state[0]:
        both = edges.select(F.explode(F.array(F.struct(F.col("high").alias("u"), F.col("low").alias("v")), F.struct(F.col("low").alias("u"), F.col("high").alias("v")))).alias("e")).select("e.u", "e.v")
        large = _stars(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "edges")
        small = _stars(large)
        tied = small.select(F.explode(F.array(F.struct(F.col("u").alias("high"), F.col("m").alias("low")), F.struct(F.col("v").alias("high"), F.col("m").alias("low")))).alias("e")).select("e.high", "e.low")
        edges = materialize(tied.filter("high > low").distinct(), "edges")
        before, state = state, _summary(edges)
        if state == before:
            break
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
