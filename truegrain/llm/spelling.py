"""Spelling variants by a dictionary of trie node pairs (operator 13).

The prefixes of all words are the nodes of a trie, their suffixes those of the trie of the reversed words.
With the nodes numbered, a word that lacks the character at a place is a pair of integers (the prefix node
before it, the suffix node behind it), and a word cut between two characters another. Words with the same
first pair differ in one replaced character; a word's first pair that is another's second pair has one
character more. The numbers stand for exact strings, so the neighbours are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.session import materialize

#: Code points and occurrences that a word has at least, how much commoner a form is, and which runs lose a code point.
LENGTH, OCCURS, TIMES, EDITED = 7, 2, 10, 31
#: Distinct words whose counts a task holds before it sends them on.
HELD = 200_000
#: A node's number is the task that made it, shifted, and the node's place there; the root of a trie is 0.
SHIFT = 40


def word_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(word, n): occurrences of the words in all texts, partial sums of the tasks added up."""

    def count(batches):
        import re
        import zlib
        from collections import Counter

        import pyarrow as pa

        runs = re.compile(f"[a-zÀ-ÿ]{{{LENGTH},}}").findall
        sums: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not value.is_valid:
                    continue
                before = zlib.crc32(f"{name}:".encode())
                low = value.as_py().encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                for run, n in Counter(runs(low)).items():
                    h = zlib.crc32(run.encode(), before)
                    if h % EDITED == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < LENGTH:
                            continue
                    sums[run] += n
                if len(sums) > HELD:
                    yield rows()
                    sums.clear()
        yield rows()

    name = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    counted = docs.select(name.alias("name"), F.col(f"`{text}`").alias("text")).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= OCCURS)


def shared(a: str, b: str) -> int:
    """Characters that two words have in common at their beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def trie(words: DataFrame, name: str) -> DataFrame:
    """`words` with `path`: the numbers of the trie nodes of the prefixes of column `spelled`, from the root to the whole.

    The distinct words are sorted by ranges, so no task has many more than another, whatever they
    begin with. A word has the nodes of the word before it as far as the two agree and new ones beyond.
    What the first word of a task shares with the last one of the task before is only known when
    all have ended: its nodes are renumbered by a table of a few rows a task.
    """
    kept = [f.name for f in words.schema]
    place = kept.index("spelled")

    def number(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        made, last, path = task << SHIFT, "", [0]
        for batch in batches:
            paths = []
            for word in batch.column(place).to_pylist():
                n = shared(last, word)
                path = path[: n + 1] + list(range(made + 1, made + 1 + len(word) - n))
                # of sorted distinct words none is the beginning of the one before
                made, last = path[-1], word
                paths.append(path)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(paths, pa.list_(pa.int64())), pa.array([task] * len(paths), pa.int64())], names=[*kept, "path", "task"])

    schema = T.StructType([*words.schema, T.StructField("path", T.ArrayType(T.LongType())), T.StructField("task", T.LongType())])
    ordered = words.repartitionByRange("spelled").sortWithinPartitions("spelled")
    rows = materialize(ordered.mapInArrow(number, schema), name)

    # the first and last word of each task, in order of the tasks: a row or two for each task
    ends = rows.groupBy("task").agg(F.min_by(F.struct("spelled", "path"), "spelled").alias("low"), F.max_by(F.struct("spelled", "path"), "spelled").alias("high"))
    own: dict[int, int] = {}
    last, path = "", [0]
    for r in sorted(ends.collect(), key=lambda r: r.task):
        n = shared(last, r.low.spelled)
        own.update({made: kept for made, kept in zip(r.low.path[1 : n + 1], path[1 : n + 1], strict=True)})
        last, path = r.high.spelled, [own.get(node, node) for node in r.high.path]
    if not own:
        return rows.drop("task")

    def renumber(batches):
        import pyarrow as pa

        tasks = {made >> SHIFT for made in own}
        for batch in batches:
            at = batch.schema.get_field_index("path")
            paths, of = batch.column(at).to_pylist(), batch.column("task").to_pylist()
            paths = [[own.get(node, node) for node in p] if t in tasks else p for p, t in zip(paths, of, strict=True)]
            yield batch.set_column(at, "path", pa.array(paths, pa.list_(pa.int64())))

    return rows.mapInArrow(renumber, rows.schema).drop("task")


def dictionary(words: DataFrame) -> DataFrame:
    """(before, behind, id, n, cut, once): the node pairs of words (id, n, path, reversed path `back`).

    `cut` rows have nothing between the nodes, one for each place; the others lack the character there.
    Of a run of equal characters each lacks the same, so `once` marks the first of them.
    """
    path, back, length = F.col("path"), F.col("back"), F.size("path") - 1
    characters = F.split("word", "")
    same = lambda i: (i > 0) & (F.get(F.col("letters"), i - 1) == F.get(F.col("letters"), i))
    lacks = F.transform(F.sequence(F.lit(0), length - 1), lambda i: F.struct(F.get(path, i).alias("before"), F.get(back, length - 1 - i).alias("behind"), F.lit(False).alias("cut"), (~same(i)).alias("once")))
    cuts = F.transform(F.sequence(F.lit(0), length), lambda i: F.struct(F.get(path, i).alias("before"), F.get(back, length - i).alias("behind"), F.lit(True).alias("cut"), F.lit(True).alias("once")))
    rows = words.withColumn("letters", characters).select("id", "n", F.explode(F.concat(lacks, cuts)).alias("k"))
    return rows.select("k.before", "k.behind", "id", "n", "k.cut", "k.once")


def neighbours(pairs: DataFrame) -> DataFrame:
    """(id, n_near, best): how many near words a word has, and the struct (n, -id, id) of the commonest, least one.

    The words of one node pair lack one character of as many as the alphabet has, and one word at most
    is cut there, so groups are small; their facts serve all members and no pairs are listed. Two words
    of equal length meet at one place, others at one place of those marked `once`.
    """
    group = Window.partitionBy("before", "behind")
    entry = F.struct("n", (-F.col("id")).alias("least"), "id")
    lacking, single = ~F.col("cut"), ~F.col("cut") & F.col("once")
    met = pairs.withColumns({
        "rows": F.count("*").over(group),
        "lack": F.count(F.when(lacking, 1)).over(group),
        "singles": F.count(F.when(single, 1)).over(group),
        "top": F.max(F.when(lacking, entry)).over(group),
        "single": F.max(F.when(single, entry)).over(group),
        "whole": F.max(F.when(F.col("cut"), entry)).over(group),
    }).filter("rows > 1")
    # the commonest other word that lacks a character: the first, or for itself the second
    second = F.max(F.when(lacking & (F.col("id") != F.col("top.id")), entry)).over(group)
    met = met.withColumn("second", second)
    other = F.when(F.col("id") == F.col("top.id"), F.col("second")).otherwise(F.col("top"))
    with_whole = F.col("once") & F.col("whole").isNotNull()
    near = F.when(F.col("cut"), F.col("singles")).otherwise(F.col("lack") - 1 + F.when(with_whole, 1).otherwise(0))
    best = F.when(F.col("cut"), F.col("single")).otherwise(F.greatest(other, F.when(with_whole, F.col("whole"))))
    return met.select("id", near.alias("near"), best.alias("best")).filter("near > 0").groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def followed(forms: DataFrame) -> DataFrame:
    """(id, root) from (id, form): where the forms lead. Each is TIMES as common as the word before, so a chain is short."""
    roots = forms.select("id", F.col("form").alias("root"))
    while True:
        roots = materialize(roots, "forms")
        ahead = roots.select(F.col("id").alias("root"), F.col("root").alias("further"))
        if roots.join(ahead, "root", "left_semi").isEmpty():
            return roots
        roots = roots.join(ahead, "root", "left").select("id", F.coalesce("further", "root").alias("root"))


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts.

    Words are runs of ASCII letters and U+00C0 to U+00FF, A-Z lower-cased, of LENGTH code points and OCCURS
    occurrences at least, after the documents' own runs have lost a code point where the hash says so.
    A word's form is the commonest word at one inserted, deleted or replaced code point, the least of
    equals, if it is TIMES as common; the root is where the forms lead. Null texts have no words, a null
    key counts as empty text, repeated rows count as documents of their own. An empty table gives no
    rows, other columns don't matter. A very long run is one word with as many node pairs as twice its
    length.
    """
    counts = materialize(word_counts(docs, key, text), "words")
    # a word's own node is its number; nodes are made in the order of words, so the least number is the least of equals
    spelled = counts.select("word", "n", F.col("word").alias("spelled"))
    ordered = materialize(trie(spelled, "prefixes").select("word", "n", "path", F.element_at("path", -1).alias("id")), "numbered")
    backward = trie(ordered.select("id", F.reverse("word").alias("spelled")), "suffixes").select("id", F.col("path").alias("back"))
    both = materialize(ordered.join(backward, "id"), "paths")
    near = materialize(neighbours(dictionary(both)), "near")
    best = near.filter(F.col("best").isNotNull()).select("id", "n_near", F.col("best.id").alias("near_id"), F.col("best.n").alias("near_n"))
    words = ordered.select("id", "word", "n").join(best, "id", "left")
    taken = F.col("near_n") >= F.col("n") * TIMES
    words = words.select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(taken, F.col("near_id")).alias("form_id"), F.when(taken, F.col("near_n")).alias("form_n"))
    words = materialize(words, "variants")
    formed = words.filter("form_id is not null")
    roots = followed(formed.select("id", F.col("form_id").alias("form")))
    form = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    root = words.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    named = formed.join(roots.withColumnRenamed("root", "root_id"), "id").join(form, "form_id").join(root, "root_id").select("word", "form", "root", "n", "n_near", "form_n")
    alone = words.filter("form_id is null").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return named.unionByName(alone)
