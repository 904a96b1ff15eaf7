"""A training corpus from raw documents: toxicity, exact copies, near copies, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result to the shared
folder and reads it again as the next stage's documents, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from truegrain.llm.common import small_batches
from truegrain.llm.exact_dedup import drop_copies
from truegrain.llm.mixing import mixed_documents
from truegrain.llm.packing import pack
from truegrain.llm.simhash import drop_near_copies
from truegrain.llm.toxicity import drop_toxic
from truegrain.session import load, materialize


def keep_harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores under 0.5."""
    small_batches(spark)
    return drop_toxic(docs, load(spark, sf_dir, "labels"))


def keep_one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for A-Z case the one with the largest doc_id."""
    small_batches(spark)
    return drop_copies(docs)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents tied by a 5-word Jaccard similarity of 0.8 the one with the least doc_id."""
    small_batches(spark)
    return drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come near their target weights."""
    small_batches(spark)
    return mixed_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in windows of 4096 tokens."""
    small_batches(spark)
    return pack(docs)


STAGES = [
    ("toxicity", keep_harmless),
    ("exact_dedup", keep_one_of_equal),
    ("simhash_near_dedup", keep_one_of_near),
    ("mix_sources", mix),
    ("packing", pack_windows),
]

#: SQL can express neither the fitted classifier nor the tokenizer; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
