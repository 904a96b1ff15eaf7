"""What the operators of this package share: folds of ids, fixed-size bitmaps, ranks, dropping rows.

Names that begin with an underscore are the package's own. Stages that return documents carry the columns of
their input as one struct, so a column of such a name is neither lost nor in the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.session import materialize

#: Words are runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bits of a bitmap; at 64 a row it has at most 2^24 / 64 rows, which bounds its broadcast to some 10 MB.
BITMAP_BITS = 24


#: Texts that go to a Python worker at once, by rows and by bytes, whatever their lengths.
BATCH_ROWS, BATCH_BYTES = 1000, "16m"


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python in batches of bounded size, so the memory of workers follows neither their number nor their lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def carried(docs: DataFrame, key: str, text: str, **more: str) -> DataFrame:
    """(_row, _id, _text, ...): all columns of the documents as one struct, and those that a stage reads."""
    named = [F.col(f"`{c}`").alias(a) for a, c in {"_id": key, "_text": text, **more}.items()]
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), *named)


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo folds; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def fraction(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the columns only."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)) / F.lit(float(1 << 52))


def bitmap(hashes: DataFrame, column: str, bits: int = BITMAP_BITS) -> DataFrame:
    """The places hash mod 2^bits that occur, 64 to a row: (_word, _mask), at most 2^bits / 64 rows."""
    place = F.pmod(F.col(column), F.lit(1 << bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    return hashes.select(F.shiftright(place, 6).alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_mask"))


def in_bitmap(df: DataFrame, column: str, words: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """Add _hit: false means that the hash is certainly not in the bitmap. The bitmap's size is fixed, so it is broadcast."""
    place = F.pmod(F.col(column), F.lit(1 << bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    joined = df.withColumn("_at", F.shiftright(place, 6)).join(F.broadcast(words), F.col("_at") == F.col("_word"), "left")
    return joined.withColumn("_hit", F.coalesce(F.col("_mask").bitwiseAND(bit) != 0, F.lit(False))).drop("_at", "_word", "_mask")


def numbered(df: DataFrame, key: str, rank: str) -> DataFrame:
    """Add a rank from 0 without gaps within each value of `key`, which has few values.

    Each task counts its own rows while the (narrow) frame is written; the counts of the tasks before
    it are added afterwards. No task sees more rows than it has read, however common a value is.
    """
    schema = T.StructType([*(f for f in df.schema if f.name not in ("_part", "_local")), T.StructField("_part", T.LongType()), T.StructField("_local", T.LongType())])

    def count(batches):
        import numpy as np
        import pandas as pd
        import pyarrow as pa
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            values = pd.Series(batch.column(key).to_pylist(), dtype=object)
            local = values.groupby(values, dropna=False).cumcount().to_numpy() + np.array([seen.get(v, 0) for v in values], dtype=np.int64)
            for value, n in values.value_counts(dropna=False).items():
                seen[value] = seen.get(value, 0) + int(n)
            columns = [batch.column(f.name) for f in schema if f.name not in ("_part", "_local")]
            columns += [pa.array(np.full(len(values), part, dtype=np.int64)), pa.array(local.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    rows = materialize(df.mapInArrow(count, schema), "numbered")
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(key, "_part").agg(F.count("*").alias("_n")).select(F.col(key).alias("_key"), F.col("_part").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    offsets = materialize(offsets, "offsets")
    joined = rows.join(offsets, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_at")))
    return joined.withColumn(rank, F.col("_before") + F.col("_local")).drop("_part", "_local", "_key", "_at", "_before", "_n")


def class_sample(rows: DataFrame, label: str, size: int, *seeds: Column) -> tuple[DataFrame, dict]:
    """About `size` rows in all, as many of each class as there are; and the rows of each class.

    A row is taken if its hash is under the rate of its class, so the sample needs no sort and its
    size is `size` but for chance. The classes are values of a label, which are few.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    each = size / max(1, len(counts))
    rate = F.lit(0.0)
    for value, n in counts.items():
        rate = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, each / n))).otherwise(rate)
    return rows.filter(fraction(F.lit("sample"), *seeds) < rate), counts


def decisions(rows: DataFrame, best: Column) -> DataFrame:
    """Which rows a group gives up: (_id, _digest, _drop) from rows of (_id, _digest, _group), for groups of two rows and more.

    `best` is an aggregate that gives the struct (_id, _digest) to stay. A row that stays and occurs
    several times is listed with _drop false. Rows of one group join through its few group facts, so
    adaptive execution can split a hot group.
    """
    groups = materialize(rows.groupBy("_group").agg(F.count("*").alias("_n"), best.alias("_best")).filter("_n > 1"), "groups")
    met = rows.join(groups, "_group")
    stays = F.col("_id").eqNullSafe(F.col("_best._id")) & (F.col("_digest") == F.col("_best._digest"))
    counted = met.groupBy("_id", "_digest", (~stays).alias("_drop")).agg(F.count("*").alias("_n"))
    return materialize(counted.filter("_drop or _n > 1").drop("_n"), "decisions")


def apply_decisions(docs: DataFrame, listed: DataFrame, key: str, text: str) -> DataFrame:
    """`docs` without the rows to drop, and once each row that is listed to stay.

    Rows whose hash is not in the bitmap of the list pass without a shuffle; the others are looked up.
    """
    tagged = carried(docs, key, text).withColumn("_digest", F.xxhash64(F.coalesce(F.col("_text"), F.lit("")))).drop("_text").withColumn("_both", F.xxhash64("_id", "_digest"))
    words = materialize(bitmap(listed.select(F.xxhash64("_id", "_digest").alias("_both")), "_both"), "bitmap")
    flagged = in_bitmap(tagged, "_both", words)
    facts = listed.select(F.col("_id").alias("_lid"), F.col("_digest").alias("_ldigest"), "_drop")
    looked = flagged.filter("_hit").join(facts, F.col("_id").eqNullSafe(F.col("_lid")) & (F.col("_digest") == F.col("_ldigest")), "left")
    out = flagged.filter("not _hit").select("_row").unionByName(looked.filter("_drop is null").select("_row"))
    if not listed.filter("not _drop").isEmpty():
        out = out.unionByName(looked.filter("not _drop").dropDuplicates(["_id", "_digest"]).select("_row"))
    return out.select("_row.*")


def whole_groups(batches, keys):
    """From Arrow batches sorted by `keys`: dicts of numpy columns that hold whole groups only."""
    import numpy as np

    rest = None
    for batch in batches:
        part = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}
        part = part if rest is None else {k: np.concatenate([rest[k], v]) for k, v in part.items()}
        differs = np.zeros(max(0, len(part[keys[0]]) - 1), dtype=bool)
        for k in keys:
            differs |= part[k][1:] != part[k][:-1]
        ends = np.flatnonzero(differs)
        cut = int(ends[-1]) + 1 if len(ends) else 0
        if cut:
            yield {k: v[:cut] for k, v in part.items()}
        rest = {k: v[cut:] for k, v in part.items()}
    if rest is not None and len(rest[keys[0]]):
        yield rest


def group_starts(part, keys):
    """First row of each group of a dict of sorted numpy columns, and the number of rows at the end."""
    import numpy as np

    n = len(part[keys[0]])
    differs = np.ones(n, dtype=bool)
    if n:
        differs[1:] = False
        for k in keys:
            differs[1:] |= part[k][1:] != part[k][:-1]
    return np.append(np.flatnonzero(differs), n)
