"""Near duplicates by SimHash and BK-trees over shards of fingerprints (operator 8)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.llm.common import apply_decisions, decisions, group_starts, whole_groups
from truegrain.llm.components import components
from truegrain.llm.near_copies import near_sets, sketches
from truegrain.session import materialize

#: Fingerprints at this many differing bits are linked.
RADIUS = 2
#: A fingerprint is cut into BLOCKS parts; two that differ in RADIUS bits agree in BLOCKS - RADIUS parts at least.
BLOCKS = 5


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit fingerprint: A-Z lower-cased, words between ASCII white space, XXH64 of each shingle."""
    from itertools import islice

    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    hashes = (xxhash.xxh64_intdigest(b" ".join(t), seed) for t in zip(*(words[i:] for i in range(width)), strict=False))
    ones, n = np.zeros(64, dtype=np.int64), len(words) - width + 1
    while len(block := np.fromiter(islice(hashes, 1 << 16), dtype="<u8")):
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def fingerprint(texts):
    """The fingerprint of each text as a signed 64-bit number; null and blank texts have 0."""
    import numpy as np
    import pyarrow as pa

    return pa.array(np.array([simhash(t.as_py()) for t in texts], dtype=np.uint64).view(np.int64))


class BKTree:
    """Distinct fingerprints; a child hangs below its parent by its Hamming distance to it."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        at, own = 0, len(self.values)
        while own:
            d = (value ^ self.values[at]).bit_count()
            if d not in self.children[at]:
                self.children[at][d] = own
                break
            at = self.children[at][d]
        self.values.append(value)
        self.children.append({})
        return own

    def near(self, value: int, radius: int) -> list[int]:
        """Nodes within the radius: below a node at distance d only edges from d - radius to d + radius can lead there."""
        found, open_ = [], [0] if self.values else []
        while open_:
            at = open_.pop()
            d = (value ^ self.values[at]).bit_count()
            if d <= radius:
                found.append(at)
            below = self.children[at]
            open_ += [below[e] for e in range(d - radius, d + radius + 1) if e in below] if len(below) > 2 * radius else [c for e, c in below.items() if abs(e - d) <= radius]
        return found


def linked(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """(value, least value) within the groups that links of a shard's tree form, for all but the least."""
    tree, above = BKTree(), list(range(len(values)))

    def root(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    for value in values:
        near = tree.near(value, radius)
        own = tree.add(value)
        for other in near:
            a, b = root(own), root(other)
            if a != b:
                low, high = (a, b) if values[a] < values[b] else (b, a)
                above[high] = low
    return [(values[i], values[root(i)]) for i in range(len(values)) if root(i) != i]


def masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """Bit masks, signed, that keep all but `radius` of the blocks."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    kept = [sum(c) for c in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in kept]


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that connect all fingerprints within the radius, from distinct fingerprints `_print`.

    Two such fingerprints agree on the kept bits of one mask at least, so each fingerprint goes to one
    shard for each mask, keyed by those bits. A shard's members share some 38 bits; copies have met
    before. Its BK-tree is built where its members arrive, and each looks for its neighbours there.
    """
    keys = [F.struct(F.lit(i).alias("i"), F.col("_print").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks())]
    sharded = distinct.select("_print", F.explode(F.array(*keys)).alias("_s")).select(F.col("_s.i").alias("i"), F.col("_s.key").alias("key"), "_print")
    names = ["i", "key"]

    def search(batches):
        import pyarrow as pa

        for part in whole_groups(batches, names):
            starts, values, links = group_starts(part, names), part["_print"], []
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if e - s > 1:
                    links += linked([v & 0xFFFFFFFFFFFFFFFF for v in values[s:e].tolist()])
            signed = [[v - (1 << 64) if v >= 1 << 63 else v for v in column] for column in (zip(*links, strict=True) if links else ((), ()))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in signed], names=["a", "b"])

    return sharded.repartition(*names).sortWithinPartitions(*names).mapInArrow(search, "a long, b long")


def near_groups(rows: DataFrame) -> DataFrame:
    """(_print, _group, ...) for each distinct fingerprint of rows (_id, _print, ...): _group is the least fingerprint reachable."""
    distinct = materialize(rows.select("_print").distinct(), "prints")
    roots = materialize(components(fingerprint_links(distinct)), "roots")
    return distinct.join(roots, F.col("_print") == F.col("node"), "left").select("_print", F.coalesce("root", "_print").alias("_group"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id) of every document.

    fingerprint is 16 lower-case hex digits; component_id is the least key that links reach, null if
    none of the component's rows has a key. Texts without words have fingerprint zero and are linked
    by it. Copies meet as one fingerprint, so a large group of them costs one row here.
    """
    rows = materialize(docs.select(F.col(key).alias("_id"), fingerprint(F.col(text)).alias("_print")), "fingerprints")
    ids = materialize(rows.groupBy("_print").agg(F.min("_id").alias("_least")), "least")
    grouped = near_groups(ids).withColumnRenamed("_print", "_p")
    grouped = materialize(ids.join(grouped, F.col("_print") == F.col("_p")).select("_print", "_least", "_group"), "grouped")
    large = grouped.filter("_print != _group").select(F.col("_group").alias("_g")).distinct()
    met = grouped.join(large, F.col("_group") == F.col("_g"), "left_semi")
    least = met.groupBy("_group").agg(F.min("_least").alias("_component")).withColumnRenamed("_group", "_g")
    named = grouped.join(least, F.col("_group") == F.col("_g"), "left").select(F.col("_print").alias("_p"), F.when(F.col("_g").isNotNull(), F.col("_component")).otherwise(F.col("_least")).alias("component_id"))
    named = materialize(named, "named")
    out = rows.join(named, F.col("_print") == F.col("_p"))
    return out.select(F.col("_id").alias(key), F.lpad(F.lower(F.hex("_print")), 16, "0").alias("fingerprint"), "component_id")


def fingerprint_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): each set of rows (_print, _set) that is not the least of its fingerprints' group, and that least one.

    Groups are those that fingerprints within RADIUS form, found in the shards' BK-trees.
    """
    tied = materialize(rows.select("_print", "_set").distinct(), "tied")
    groups = near_groups(tied).withColumnRenamed("_print", "_p")
    grouped = materialize(tied.join(groups, F.col("_print") == F.col("_p")).select("_set", "_group"), "tied_groups")
    least = grouped.groupBy("_group").agg(F.min("_set").alias("b"))
    return grouped.join(least, "_group").filter("_set != b").select(F.col("_set").alias("a"), "b").distinct()


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with their columns, of each group of near copies the one with the least key (then text hash); a null key loses.

    Fingerprints within RADIUS propose pairs of texts, which an exact similarity of 0.8 in five-word shingles confirms. Two bits
    do not reach all copies at that similarity, so MinHash bands propose the others, confirmed likewise.
    Texts without words are one group, rows that repeat a key and text are one document. An empty table gives no rows.
    """
    rows = materialize(sketches(docs, key, text, simhash), "sketches")
    groups = materialize(near_sets(docs, rows, text, fingerprint_pairs(rows)), "grouped")
    grouped = materialize(rows.join(groups, "_set", "left").select("_id", "_digest", F.coalesce("_group", "_set").alias("_group")), "members")
    best = F.min(F.struct(F.col("_id").isNull().alias("_none"), F.col("_id"), F.col("_digest")))
    return apply_decisions(docs, decisions(grouped, best), key, text)
