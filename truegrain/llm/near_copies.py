"""Near copies by the Jaccard similarity of their word shingles: MinHash bands propose pairs, the shingle sets decide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.llm.chosen_path import SMALL, dealt, exact_links, sifted_members, sketched
from truegrain.llm.common import bitmap, in_bitmap
from truegrain.llm.components import components
from truegrain.session import materialize

#: Texts are near copies if the sets of their runs of SHINGLE words have this Jaccard similarity or more.
SHINGLE, SIMILAR = 5, 0.8
#: Two texts meet if all ROWS minima of one of BANDS bands agree: at 0.8 all bands differ once in 150,000 pairs.
BANDS, ROWS = 30, 5


def shingle_hashes(text: str | None, width: int = SHINGLE):
    """Distinct XXH64 of the runs of words, sorted; A-Z lower-cased. A shorter text is one run, one without words has 0."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(1, dtype=np.uint64)
    width = min(width, len(words))
    runs = zip(*(words[i:] for i in range(width)), strict=False)
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(r)) for r in runs), dtype=np.uint64, count=len(words) - width + 1))


def set_name(hashes) -> int:
    """Signed 64-bit hash of a set of shingles."""
    import xxhash

    value = xxhash.xxh64_intdigest(hashes.tobytes(), 1)
    return value - (1 << 64) if value >= 1 << 63 else value


def permutations():
    """Odd factors and summands, one pair for each minimum."""
    import numpy as np

    drawn = np.random.default_rng(5).integers(0, 1 << 64, size=(2, BANDS * ROWS), dtype=np.uint64)
    return drawn[0] | np.uint64(1), drawn[1]


def band_keys(hashes, factors, summands):
    """The key of each band, signed: a hash of its number and its minima."""
    import numpy as np
    import xxhash

    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for s in range(0, len(hashes), 2048):
        turned = np.multiply.outer(factors, hashes[s : s + 2048])
        turned += summands[:, None]
        turned ^= turned >> np.uint64(32)
        turned *= np.uint64(0x9E3779B97F4A7C15)
        np.minimum(least, turned.min(axis=1), out=least)
    bands = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(bands)], dtype=np.uint64).view(np.int64)


def sketches(docs: DataFrame, key: str, text: str, fingerprint) -> DataFrame:
    """(_id, _digest, _print, _set, _size, _bands) of every document; _print is its unsigned `fingerprint` as a signed number."""

    def sketch(batches):
        import numpy as np
        import pyarrow as pa

        factors, summands = permutations()
        for batch in batches:
            prints, sets, sizes, bands = [], [], [], []
            for value in batch.column(2):
                hashes = shingle_hashes(value.as_py())
                prints.append(fingerprint(value.as_py()))
                sets.append(set_name(hashes))
                sizes.append(len(hashes))
                bands.append(band_keys(hashes, factors, summands))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(prints, dtype=np.uint64).view(np.int64)), pa.array(sets, pa.int64()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], names=["_id", "_digest", "_print", "_set", "_size", "_bands"])

    schema = T.StructType([T.StructField("_id", docs.schema[key].dataType), *(T.StructField(n, T.LongType()) for n in ("_digest", "_print", "_set", "_size")), T.StructField("_bands", T.ArrayType(T.LongType()))])
    digest = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    return docs.select(F.col(key).alias("_id"), digest.alias("_digest"), F.col(text).alias("_text")).mapInArrow(sketch, schema)


def shingle_sets(docs: DataFrame, digests: DataFrame, text: str) -> DataFrame:
    """(_set, _hashes) of the texts whose hash is in `digests` (_digest); some others may be among them."""

    def sets(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for value in batch.column(0):
                hashes = shingle_hashes(value.as_py())
                one = pa.ListArray.from_arrays(pa.array([0, len(hashes)], pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([set_name(hashes)], pa.int64()), one], names=["_set", "_hashes"])

    rows = docs.select(F.col(text).alias("_text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_digest"))
    words = materialize(bitmap(digests, "_digest"), "bitmap")
    return in_bitmap(rows, "_digest", words).filter("_hit").select("_text").mapInArrow(sets, "_set long, _hashes array<long>")


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of shingle sets whose Jaccard similarity is SIMILAR or more, exactly."""
    left = sets.select(F.col("_set").alias("a"), F.col("_hashes").alias("_left"))
    right = sets.select(F.col("_set").alias("b"), F.col("_hashes").alias("_right"))
    both = F.size(F.array_intersect("_left", "_right"))
    met = pairs.join(left, "a").join(right, "b")
    # in whole numbers, as a similarity of just 0.8 counts
    return met.filter(both * 10 >= (F.size("_left") + F.size("_right") - both) * int(SIMILAR * 10)).select("a", "b")


def near_sets(docs: DataFrame, rows: DataFrame, text: str, met_before: DataFrame) -> DataFrame:
    """(_set, _group) for the shingle sets of `rows` that similar pairs tie to a lesser one, the least reachable.

    The pairs (a, b) of `met_before`, of different sets in `rows`, are compared first; bands propose the others.
    Members of a band's group are first compared with its least member, then those that this leaves
    in different components with each other, in the tasks that hold them: blocks of a group first, and what
    is still apart in each two blocks of a group. Only links that connect sets leave a task, so neither
    near copies nor texts of one template are listed in pairs.
    """
    distinct = rows.select("_set", "_size", "_bands").dropDuplicates(["_set"])
    keyed = materialize(distinct.select("_set", "_size", F.explode("_bands").alias("_band")), "bands")
    least = keyed.groupBy("_band").agg(F.count("*").alias("_n"), F.min(F.struct("_set", "_size")).alias("_first")).filter("_n > 1").drop("_n")
    met = materialize(keyed.join(least, "_band"), "met")
    # sizes of similar sets are within SIMILAR of each other
    close = lambda a, b: F.least(a, b) * 10 >= F.greatest(a, b) * int(SIMILAR * 10)
    partnered = met.filter((F.col("_set") != F.col("_first._set")) & close(F.col("_size"), F.col("_first._size")))
    stars = partnered.select(F.col("_set").alias("a"), F.col("_first._set").alias("b")).unionByName(met_before.select("a", "b"))
    stars = materialize(stars.distinct(), "stars")
    named = met.select("_set").unionByName(stars.select(F.col("a").alias("_set"))).unionByName(stars.select(F.col("b").alias("_set")))
    digests = rows.groupBy("_set").agg(F.min("_digest").alias("_digest")).join(named.distinct(), "_set", "left_semi")
    sets = materialize(shingle_sets(docs, digests.select("_digest"), text).dropDuplicates(["_set"]), "sets")
    links = materialize(similar(stars, sets), "links")
    full = sets.select(F.col("_set").alias("set"), F.col("_hashes").alias("hashes"))
    cells = materialize(full.select("set", sketched("hashes").alias("cells")), "cells")
    members = met.select(F.col("_band").alias("node"), F.col("_set").alias("set"), F.col("_size").alias("size"))
    percent = int(SIMILAR * 100)
    roots = materialize(components(links), "roots")
    for whole in (False, True):
        tagged = members.join(roots.withColumnRenamed("node", "set"), "set", "left").select("node", "set", "size", F.coalesce("root", "set").alias("root"))
        tagged = materialize(tagged, "tagged")
        facts = tagged.groupBy("node").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("node", "n")
        members = materialize(tagged.join(facts, "node"), "apart")
        near = materialize(sifted_members(dealt(members, pairs=whole), cells, percent), "sifted")
        more = materialize(exact_links(near, full, percent), "links")
        roots = materialize(components(more.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))), "roots")
        # groups of one block are settled
        members = members.filter(F.col("n") > SMALL).select("node", "set", "size")
        if members.isEmpty():
            break
    return roots.select(F.col("node").alias("_set"), F.col("root").alias("_group"))
