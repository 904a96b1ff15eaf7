"""Near copies by a chosen-path similarity join of word shingle sets (operator 12).

Trees of random choices split the sets: a node chooses one or two of COORDINATES minwise tokens, and a set
goes to the child that its own token names. Paths follow from the choices and the set alone, so every set
finds its nodes in its task. Nodes are counted from depth START on; those with one set or with sets
that are linked already end, small ones are compared exhaustively, large ones branch on. A pair at the
threshold stays together for one level with that probability and a node chooses 1 / threshold tokens on
average, so deep levels lose few pairs; independent trees bring the recall to its target. Links are
confirmed on the full sets, and of a node's links only so many leave its task as connect its sets.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.llm.common import bitmap, group_starts, in_bitmap, whole_groups
from truegrain.llm.components import components
from truegrain.session import materialize

#: Words of a shingle, and the similarity in hundredths from which sets are linked.
WIDTH, SIMILAR = 3, 85
#: Minwise tokens of a set, and the cells of the sketch by which pairs are sifted.
COORDINATES, CELLS = 24, 512
#: Depth at which nodes are counted first, and at which they are compared whatever their size.
START, DEPTH = 2, 12
#: Nodes of up to SMALL sets are compared at once. Larger ones go in blocks, each with each, where all of them take
#: up to WORK comparisons a set of the corpus, and at DEPTH; otherwise they branch once their blocks are compared.
SMALL, WORK = 1024, 4096
#: Share of the pairs at the threshold that some tree has together at depth START.
RECALL = 0.9999
#: Deviations by which a sketch may miss the threshold.
SLACK = 4.5


def trees(similar: int = SIMILAR, recall: float = RECALL) -> int:
    """Independent trees of which one at least has a pair at the threshold together with probability `recall`."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (similar / 100) ** START))


def mixed(x):
    """64-bit numbers well mixed."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """Word -> 64-bit hash; words are kept up to a bound."""

    KEPT, LENGTH = 100_000, 24

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh64_intdigest(word)
        if len(word) <= self.LENGTH:
            if len(self) >= self.KEPT:
                self.clear()
            self[word] = value
        return value


def shingle_hashes(text: str | None, hash_of: Words, width: int = WIDTH):
    """Sorted distinct 64-bit hashes of a text's shingles; fewer words are one shingle, none have no hash."""
    import numpy as np

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    hashes = np.fromiter(map(hash_of.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(width, len(words))
    if not width:
        return hashes
    run = hashes[: len(words) - width + 1] + np.uint64(width)
    for i in range(1, width):
        run = mixed(run) + hashes[i : len(words) - width + 1 + i]
    return np.unique(mixed(run))


def set_name(hashes) -> int:
    """Signed 64-bit name of a shingle set."""
    import xxhash

    value = xxhash.xxh64_intdigest(hashes.tobytes(), 12)
    return value - (1 << 64) if value >= 1 << 63 else value


def minwise(hashes, factors):
    """The least of the set's hashes times each odd factor, the upper 32 bits: its minwise token in that order."""
    import numpy as np

    return np.array([(hashes * f).min() for f in factors], dtype=np.uint64).__rshift__(np.uint64(32)).astype("<u4")


def cells(hashes):
    """CELLS bytes: the least hash of each cell, 0 for a cell without hashes. Cells follow from the top bits, so sorted hashes fill them in turn."""
    import numpy as np

    out = np.zeros(CELLS, dtype=np.uint8)
    at = (hashes >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else at
    out[at[first]] = 1 + mixed(hashes[first]) % np.uint64(255)
    return out


def sets_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, row, set, size, mins, cells) of every document; `row` tells the key and text apart, mins and cells are null without shingles."""

    def sketch(batches):
        import numpy as np
        import pyarrow as pa

        known = Words()
        factors = np.random.default_rng(12).integers(0, 1 << 63, size=COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            names, sizes, mins, sketches = [], [], [], []
            for value in batch.column(2):
                hashes = shingle_hashes(value.as_py(), known)
                names.append(set_name(hashes))
                sizes.append(len(hashes))
                mins.append(minwise(hashes, factors).tobytes() if len(hashes) else None)
                sketches.append(cells(hashes).tobytes() if len(hashes) else None)
            columns = [batch.column(0), batch.column(1), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(mins, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "set", "size", "mins", "cells"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), *(T.StructField(n, T.LongType()) for n in ("row", "set", "size")), *(T.StructField(n, T.BinaryType()) for n in ("mins", "cells"))])
    row = F.xxhash64(F.col(f"`{key}`"), F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return docs.select(F.col(f"`{key}`").alias("doc_id"), row.alias("row"), F.col(f"`{text}`").alias("text")).mapInArrow(sketch, schema)


def full_sets(docs: DataFrame, rows: DataFrame, key: str, text: str) -> DataFrame:
    """(set, hashes) of the documents whose `row` is in `rows`, once each; some others may be among them."""

    def hashed(batches):
        import numpy as np
        import pyarrow as pa

        known = Words()
        for batch in batches:
            for value in batch.column(0):
                hashes = shingle_hashes(value.as_py(), known)
                one = pa.ListArray.from_arrays(pa.array([0, len(hashes)], pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([set_name(hashes)], pa.int64()), one], names=["set", "hashes"])

    named = docs.select(F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{key}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("row"))
    words = materialize(bitmap(rows, "row"), "bitmap")
    found = in_bitmap(named, "row", words).filter("_hit").select("text").mapInArrow(hashed, "set long, hashes array<long>")
    return found.dropDuplicates(["set"])


def choices(tree: int):
    """The order in which a tree takes the coordinates; the first START of different trees differ as far as there are enough."""
    import numpy as np

    first = [(tree * START + i) % COORDINATES for i in range(START)]
    rest = np.random.default_rng([12, tree]).permutation([c for c in range(COORDINATES) if c not in first])
    return [*first, *rest.tolist()]


def nodes_at_start(sets: DataFrame, count: int) -> DataFrame:
    """(node, tree, set, size, root): the node at depth START of each set in each tree; each set is its own root."""

    def paths(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            mins = np.frombuffer(b"".join(batch.column("mins").to_pylist()), dtype="<u4").reshape(-1, COORDINATES).astype(np.uint64)
            for tree in range(count):
                node = np.full(len(mins), mixed(np.array([tree + 1], dtype=np.uint64))[0])
                for c in choices(tree)[:START]:
                    node = mixed(node ^ (mins[:, c] + np.uint64(c << 32)))
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(np.full(len(mins), tree, dtype=np.int32)), batch.column("set"), batch.column("size"), batch.column("set")], names=["node", "tree", "set", "size", "root"])

    return sets.select("set", "size", "mins").mapInArrow(paths, "node long, tree int, set long, size long, root long")


def children(members: DataFrame, sets: DataFrame, depth: int) -> DataFrame:
    """The nodes one level below for members (node, tree, set, size, root) of nodes at `depth`: one token's child, for a share of the nodes a second one's."""

    def branch(batches):
        import numpy as np
        import pyarrow as pa

        order = {}
        share = np.uint64(int((100 / SIMILAR - 1) * 2**32))
        for batch in batches:
            mins = np.frombuffer(b"".join(batch.column("mins").to_pylist()), dtype="<u4").reshape(-1, COORDINATES).astype(np.uint64)
            node, tree = batch.column("node").to_numpy().view(np.uint64), batch.column("tree").to_numpy()
            at = START + 2 * (depth - START)
            picked = np.array([order.setdefault(t, choices(t))[at : at + 2] for t in tree.tolist()], dtype=np.int64).reshape(-1, 2)
            second = (mixed(node ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)) < share
            for i, rows in ((0, np.arange(len(node))), (1, np.flatnonzero(second))):
                c = picked[rows, i]
                child = mixed(node[rows] ^ (mins[rows, c] + (c.astype(np.uint64) << np.uint64(32))))
                kept = [batch.column(n).take(pa.array(rows)) for n in ("tree", "set", "size", "root")]
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), *kept], names=["node", "tree", "set", "size", "root"])

    joined = members.join(sets.select("set", "mins"), "set").select("node", "tree", "set", "size", "root", "mins")
    return joined.mapInArrow(branch, "node long, tree int, set long, size long, root long")


def close(a, b):
    """Whether the sizes of two sets allow the similarity."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * SIMILAR


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets have the similarity, in whole numbers."""
    left = sets.select(F.col("set").alias("a"), F.col("hashes").alias("left"))
    right = sets.select(F.col("set").alias("b"), F.col("hashes").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    met = pairs.join(left, "a").join(right, "b")
    return met.filter(both * 100 >= (F.size("left") + F.size("right") - both) * SIMILAR).select("a", "b")


def alike(a, b, similar: int = SIMILAR):
    """For sketches a (n rows) and b (m rows): whether the share of equal cells allows the similarity, SLACK deviations below it."""
    import numpy as np

    out = np.zeros((len(a), len(b)), dtype=bool)
    for i in range(len(a)):
        used = ((a[i] | b) != 0).sum(axis=1)
        same = ((a[i] == b) & (b != 0)).sum(axis=1)
        at = similar / 100
        out[i] = same >= at * used - SLACK * np.sqrt(at * (1 - at) * used)
    return out


@F.arrow_udf(T.BinaryType())
def sketched(sets):
    """`cells` of sets of sorted hashes."""
    import numpy as np
    import pyarrow as pa

    return pa.array([cells(h.values.to_numpy(zero_copy_only=False).view(np.uint64)).tobytes() for h in sets], pa.binary())


@F.arrow_udf(T.BooleanType())
def sifted(a, b):
    """Whether the sketches of two sets allow the similarity."""
    import numpy as np
    import pyarrow as pa

    x, y = (np.frombuffer(b"".join(c.to_pylist()), dtype=np.uint8).reshape(-1, CELLS) for c in (a, b))
    used, same, at = ((x | y) != 0).sum(axis=1), ((x == y) & (x != 0)).sum(axis=1), SIMILAR / 100
    return pa.array(same >= at * used - SLACK * np.sqrt(at * (1 - at) * used))


def dealt(members: DataFrame, pairs: bool) -> DataFrame:
    """(node, low, high, own, set, size, root): members (node, n, set, size, root) in groups that are compared in one task.

    A node of more than SMALL sets is dealt to blocks. Each block is a group, or with `pairs` each two
    blocks, so the size of a group is bounded.
    """
    blocks = F.ceil(F.col("n") / F.lit(float(SMALL))).cast("int")
    own = members.withColumn("own", F.pmod(F.xxhash64("set", "node"), blocks).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))) if pairs else own.withColumn("other", F.col("own"))
    return met.select("node", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "set", "size", "root")


GROUP = ("node", "low", "high")


def hopeful_pairs(part, sketch, s: int, e: int, similar: int = SIMILAR):
    """Places of the pairs within rows s to e, a group, that differ in root and whose sizes and sketches allow the similarity."""
    import numpy as np

    name, size, root, side = (part[n][s:e] for n in ("set", "size", "root", "own"))
    of_low, of_high = (np.flatnonzero(side == part[n][s]) for n in ("low", "high"))
    x, y = np.nonzero(alike(sketch[of_low], sketch[of_high], similar))
    x, y = of_low[x], of_high[y]
    fits = (root[x] != root[y]) & (np.minimum(size[x], size[y]) * 100 >= np.maximum(size[x], size[y]) * similar)
    fits &= (name[x] < name[y]) | (part["low"][s] != part["high"][s])
    return x[fits] + s, y[fits] + s


def sifted_members(groups: DataFrame, sets: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """The rows of `groups` that some other member may be similar to, by the sketches."""
    names = groups.columns

    def sift(batches):
        import numpy as np
        import pyarrow as pa

        for part in whole_groups(batches, GROUP):
            starts, kept = group_starts(part, GROUP), [np.zeros(0, dtype=np.int64)]
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if e - s > 1:
                    sketch = np.frombuffer(b"".join(part["cells"][s:e]), dtype=np.uint8).reshape(-1, CELLS)
                    kept.append(np.unique(np.concatenate(hopeful_pairs(part, sketch, s, e, similar))))
            at = np.concatenate(kept)
            yield pa.RecordBatch.from_arrays([pa.array(part[n][at]) for n in names], names=names)

    with_cells = groups.join(sets.select("set", "cells"), "set").select(*names, "cells")
    return with_cells.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(sift, groups.schema)


def grouped_by(x, y):
    """The values of x, sorted, and for each an array of its y."""
    import numpy as np

    order = np.argsort(x, kind="stable")
    values, starts = np.unique(x[order], return_index=True)
    return values, np.split(y[order], starts[1:])


def exact_links(members: DataFrame, full: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """Links (a, b) that connect the similar sets of each group, by their full sets (set, hashes).

    A pair whose sets are connected already, within the group or by their roots, is passed over.
    """

    def link(batches):
        import numpy as np
        import pyarrow as pa

        for part in whole_groups(batches, GROUP):
            starts, links = group_starts(part, GROUP), []
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                hashes, name = part["hashes"][s:e], part["set"][s:e]
                x, y = hopeful_pairs(part, np.stack([cells(h.view(np.uint64)) for h in hashes]), s, e, similar)
                label = np.unique(part["root"][s:e], return_inverse=True)[1]
                for i, others in zip(*grouped_by(x - s, y - s), strict=True):
                    others = others[label[others] != label[i]]
                    while len(others):
                        j, others = others[0], others[1:]
                        both = len(np.intersect1d(hashes[i], hashes[j], assume_unique=True))
                        if both * 100 >= (len(hashes[i]) + len(hashes[j]) - both) * similar:
                            links.append((int(name[i]), int(name[j])))
                            label[label == label[j]] = label[i]
                            others = others[label[others] != label[i]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*links, strict=True) if links else ((), ()))], names=["a", "b"])

    with_sets = members.join(full, "set").select(*members.columns, "hashes")
    return with_sets.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(link, "a long, b long")


def star_links(docs: DataFrame, members: DataFrame, sets: DataFrame, key: str, text: str) -> DataFrame:
    """Links between the members of nodes and the node's first set, in their column `first`."""
    stars = members.filter((F.col("set") != F.col("first.set")) & close(F.col("size"), F.col("first.size"))).select(F.col("first.set").alias("a"), F.col("set").alias("b")).distinct()
    of_a, of_b = (sets.select(F.col("set").alias(n), F.col("cells").alias(f"cells_{n}")) for n in ("a", "b"))
    pairs = materialize(stars.join(of_a, "a").join(of_b, "b").filter(sifted("cells_a", "cells_b")).select("a", "b"), "stars")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    return materialize(confirmed(pairs, needed_sets(docs, sets, needed, key, text)), "links")


def needed_sets(docs: DataFrame, sets: DataFrame, needed: DataFrame, key: str, text: str) -> DataFrame:
    """(set, hashes) of the sets in `needed`, read again from their texts."""
    rows = sets.select("set", "row").join(needed, "set", "left_semi").select("row")
    return materialize(full_sets(docs, rows, key, text), "full")


def compared(docs: DataFrame, groups: DataFrame, sets: DataFrame, key: str, text: str) -> DataFrame:
    """Links that connect the similar sets of each group: those the sketches leave are compared by their full sets."""
    members = materialize(sifted_members(groups, sets), "sifted")
    return materialize(exact_links(members, needed_sets(docs, sets, members.select("set").distinct(), key, text)), "links")


def set_roots(docs: DataFrame, sets: DataFrame, key: str, text: str) -> DataFrame:
    """(node, root) of the distinct shingle sets (set, size, mins, cells, row) that similar ones connect to a lesser one, the least.

    The members of a node are tied to one of its sets first, which they mostly share in all trees; what
    this leaves in one component needs no more comparison, so a large group of near copies takes few.
    """
    roots = sets.sparkSession.createDataFrame([], "node long, root long")

    def joined(links: DataFrame) -> DataFrame:
        if links.isEmpty():
            return roots
        return materialize(components(links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))), "roots")

    def apart(members: DataFrame) -> DataFrame:
        """Members with their present roots, of the nodes that have several."""
        tagged = members.drop("root").join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
        tagged = materialize(tagged, "tagged")
        several = tagged.groupBy("node").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("node")
        return materialize(tagged.join(several, "node", "left_semi"), "apart")

    level, most = nodes_at_start(sets, trees()), WORK * sets.count()
    for depth in range(START, DEPTH + 1):
        level = materialize(level, "nodes")
        first = F.min(F.struct("set", "size")).alias("first")
        facts = level.groupBy("node").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"), first).filter("low < high").drop("low", "high")
        members = materialize(level.join(facts, "node"), "members")
        if depth == START:
            roots = joined(star_links(docs, members, sets, key, text))
            members = apart(members.drop("first"))
        large = members.filter(F.col("n") > SMALL)
        work = large.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        last = work <= most or depth == DEPTH
        roots = joined(compared(docs, dealt(members, pairs=last), sets, key, text))
        if last:
            break
        level = children(apart(large.drop("first")), sets, depth).distinct()
    return roots


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) of every document.

    component_id is the least key that links reach, null if none of the component's rows has a key; kept
    says whether it is the row's own. Null and blank texts have no shingles and are linked with nothing,
    each other included. Equal sets are one set here, so exact copies cost one row. Rows that repeat a
    key are documents of their own, an empty table gives no rows, other columns don't matter.
    """
    rows = materialize(sets_of(docs, key, text), "shingles")
    distinct = rows.filter("size > 0").groupBy("set").agg(F.first("size").alias("size"), F.first("mins").alias("mins"), F.first("cells").alias("cells"), F.first("row").alias("row"), F.min("doc_id").alias("least"))
    sets = materialize(distinct, "sets")
    roots = set_roots(docs, sets, key, text)
    grouped = sets.select("set", "least").join(roots, F.col("set") == F.col("node"), "left").select("set", "least", "root")
    grouped = materialize(grouped, "grouped")
    tied = grouped.select("least", F.coalesce("root", "set").alias("of")).join(roots.select(F.col("root").alias("of")).distinct(), "of", "left_semi")
    least = materialize(tied.groupBy("of").agg(F.min("least").alias("component")), "least")
    named = grouped.withColumn("of", F.coalesce("root", "set")).join(least, "of", "left")
    named = materialize(named.select(F.col("set").alias("name"), F.when(F.col("component").isNotNull(), F.col("component")).otherwise(F.col("least")).alias("component_id")), "named")
    with_set = rows.select("doc_id", "size", F.when(F.col("size") > 0, F.col("set")).alias("set"))
    out = with_set.filter("size > 0").join(named, F.col("set") == F.col("name")).select("doc_id", "size", "component_id")
    out = out.unionByName(with_set.filter("size = 0").select("doc_id", "size", F.col("doc_id").alias("component_id")))
    return out.select(F.col("doc_id").alias(key), F.col("size").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
