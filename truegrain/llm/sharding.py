"""Sharding by rendezvous hashing of stable keys over weighted shards (operator 5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.llm.common import numbered


def rendezvous(key: Column, weights: Sequence[float], seed: str = "shard") -> Column:
    """The shard 0 .. n-1 with the highest score -weight / ln(u), where u in (0, 1) hashes key and shard.

    A shard's scores depend on the key and on itself only: with one shard more, a row either stays or
    moves to the new one; with a shard's weight changed, rows move to or from that shard only. A shard
    of weight 0 takes no rows. A null key is a key like any other.
    """
    name = F.coalesce(key.cast("string"), F.lit("\u0000"))

    def score(shard: int, weight: float) -> Column:
        u = (F.pmod(F.xxhash64(F.lit(f"{seed}:{shard}"), name), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
        return F.struct((F.lit(-float(weight)) / F.log(u)).alias("score"), F.lit(-shard).alias("shard"))

    scores = [score(i, w) for i, w in enumerate(weights) if w > 0]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return (-best.getField("shard")).cast("int")


def shard_documents(docs: DataFrame, weights: Sequence[float] = (1.0,) * 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of every document.

    size is the UTF-8 bytes plus one; a null text has size 1 and the checksum of empty text. slot
    counts a shard's rows from 0 in the order they are read. grown_shard is the shard with one more of
    mean weight. Rows that repeat a key share its shard and have slots of their own.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    grown = [*weights, sum(weights) / len(weights)]
    rows = docs.select(
        F.col(key),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), grown).alias("grown_shard"),
    )
    return numbered(rows, "shard", "slot").select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
