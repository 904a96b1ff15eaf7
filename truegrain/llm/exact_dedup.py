"""Exact duplicates by progressive refinement: length, prefix hash, full hash (operator 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.llm.common import UPPER, apply_decisions, bitmap, decisions, in_bitmap
from truegrain.session import materialize

#: Characters of the prefix whose hash refines the groups of equal length.
PREFIX = 64


@F.arrow_udf(T.StringType())
def full_hash(texts):
    """sha256 of the text with A-Z lower-cased, in UTF-8, as lower-case hex; null for null."""
    import hashlib

    import pyarrow as pa
    import pyarrow.compute as pc

    low = pc.ascii_lower(texts)
    return pa.array([hashlib.sha256(t.as_buffer()).hexdigest() if t.is_valid else None for t in low], pa.string())


def _probed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """_body (null text: empty), _length in bytes and _place, a hash of length and prefix."""
    body = F.coalesce(F.col(text), F.lit(""))
    prefix = F.translate(F.substring(body, 1, PREFIX), UPPER, UPPER.lower())
    return docs.withColumn("_body", body).withColumn("_length", F.octet_length("_body")).withColumn("_place", F.xxhash64("_length", prefix))


def surviving(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The bitmap of (length, prefix hash) groups with two documents and more.

    One scan writes length and prefix hash of each document. Documents alone in their length go first,
    then those alone in length and prefix. Lowering A-Z keeps a text's length in bytes.
    """
    probes = materialize(_probed(docs, key, text).select("_length", "_place"), "probes")
    pairs = probes.groupBy("_length", "_place").agg(F.count("*").alias("_n"))
    pairs = materialize(pairs, "lengths")
    shared = pairs.groupBy("_length").agg(F.sum("_n").alias("_of_length")).filter("_of_length > 1").select("_length")
    return materialize(bitmap(pairs.join(shared, "_length", "left_semi").filter("_n > 1").select("_place"), "_place"), "survivors")


def _hashed(docs: DataFrame, words: DataFrame, key: str, text: str, all_hashes: bool = False) -> DataFrame:
    """_hash is the full hash for documents whose group survives, null for texts that are known to be unique."""
    flagged = in_bitmap(_probed(docs, key, text), "_place", words)
    content: Column = F.col("_body") if all_hashes else F.when(F.col("_hit"), F.col("_body"))
    return flagged.withColumn("_hash", full_hash(content))


def copy_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", all_hashes: bool = False) -> DataFrame:
    """(key, keep_id, group_size, kept, text_hash, unique) of every document.

    Texts are equal if their bytes are after lower-casing A-Z; a null text counts as empty. The row
    with the largest key stays; of rows that repeat that key one stays, and a null key loses to any
    other. The full hash is taken of surviving groups only (`unique` marks the rest), unless
    `all_hashes` asks for one of every text. An empty table gives no rows.
    """
    words = surviving(docs, key, text)
    rows = _hashed(docs, words, key, text, all_hashes).select(F.col(key).alias("_id"), "_hash", "_hit", F.monotonically_increasing_id().alias("_row"))
    rows = materialize(rows, "hashes")
    best = F.max(F.struct("_id", "_row")).alias("_best")
    groups = materialize(rows.filter("_hit").groupBy(F.col("_hash").alias("_group")).agg(F.count("*").alias("_n"), best).filter("_n > 1"), "groups")
    # a unique text joins nothing; its own hash or row number spreads it over the tasks
    link = F.coalesce(F.col("_hash"), F.col("_row").cast("string"))
    met = rows.withColumn("_link", link).join(groups, F.col("_link") == F.col("_group"), "left")
    grouped = F.col("_n").isNotNull()
    return met.select(
        F.col("_id").alias(key),
        F.when(grouped, F.col("_best._id")).otherwise(F.col("_id")).alias("keep_id"),
        F.coalesce(F.col("_n"), F.lit(1).cast("long")).alias("group_size"),
        F.when(grouped, F.col("_row") == F.col("_best._row")).otherwise(F.lit(True)).alias("kept"),
        F.col("_hash").alias("text_hash"),
        (~F.col("_hit")).alias("unique"),
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns. Texts that refinement shows to be unique never leave their task.

    As in `copy_groups`, null texts count as empty, the row with the largest key stays, and of rows that
    repeat that key one. An empty table gives no rows.
    """
    texts = docs.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    words = surviving(texts, "_id", "_text")
    digest = F.xxhash64("_body").alias("_digest")
    rows = _hashed(texts, words, "_id", "_text").filter("_hit").select("_id", digest, F.col("_hash").alias("_group"))
    rows = materialize(rows, "hashes")
    return apply_decisions(docs, decisions(rows, F.max(F.struct("_id", "_digest"))), key, text)
