"""Source divergence audit: how far the term shares of a language's sources lie apart (operator 11).

Per language, the vocabulary holds every term of at least MIN_DF documents (a count vectorizer with an
integer minDF whose vocabulary size has no limit). It is a table here, since a vectorizer's vocabulary on
the driver would grow with the corpus. Exact sparse document vectors are added up by (language, source)
within the tasks, and pairs of sources are evaluated on the terms that both hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truegrain.session import materialize

#: Documents that a term of the vocabulary has at least; shares are counted in units of 1 / SCALE.
MIN_DF, SCALE = 3, 1_000_000_000
#: Places of the term report of a group.
TOP = 200
#: Sums that a task holds before it sends them on, and pairs of sources that it evaluates at once.
HELD, PAIRS = 400_000, 1 << 20


def group_sums(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, df): occurrences and documents of each term, as partial sums of the tasks.

    Each group also has a row with the empty term, which no text has, so groups without terms are known.
    """

    def count(batches):
        from collections import Counter

        import pyarrow as pa

        letters = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
        sums: dict[tuple, tuple] = {}
        held = 0

        def rows():
            for (of_lang, of_source), (n, df) in sums.items():
                terms = list(n)
                columns = [pa.array([of_lang], pa.string()).take(pa.array([0] * len(terms))), pa.array([of_source], pa.string()).take(pa.array([0] * len(terms)))]
                columns += [pa.array(terms, pa.binary()).cast(pa.string()), pa.array([n[t] for t in terms], pa.int64()), pa.array([df[t] for t in terms], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "df"])

        for batch in batches:
            for value, *group in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                vector = Counter(value.as_py().translate(letters).split())
                n, df = sums.setdefault(tuple(group), (Counter({b"": 0}), Counter()))
                before = len(n)
                for term, times in vector.items():
                    n[term] += times
                df.update(vector.keys())
                held += len(n) - before
                if held > HELD:
                    yield from rows()
                    sums, held = {}, 0
        yield from rows()

    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((text, "text"), (lang, "lang"), (source, "source"))]
    return docs.select(*named).mapInArrow(count, "lang string, source string, term string, n long, df long")


def share(n: Column, total: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / total), in whole numbers of any size."""
    return F.lit(1).cast("long") + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)"), total.cast("decimal(20,0)"))


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most SCALE + 1, so the square is a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def common_gaps(entries: DataFrame) -> DataFrame:
    """(lang, g, h, value): what the terms of both groups add to the gap of g from h beyond one-sided terms.

    Each row of `entries` is a term with the groups that have it: arrays of group number, share and the
    share of a term the group lacks. Pairs are evaluated in numpy and added up within the task.
    """

    def evaluate(batches):
        import numpy as np
        import pyarrow as pa

        def f(p, q):
            return (p - q) * (p - q) // q

        sums: dict[str, list] = {}

        def compact(lang):
            keys, values = (np.concatenate(c) for c in zip(*sums[lang], strict=True))
            order = np.argsort(keys, kind="stable")
            keys, values = keys[order], values[order]
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sums[lang] = [(keys[starts], np.add.reduceat(values, starts))]

        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            lists = batch.column("of")
            offsets = lists.offsets.to_numpy()
            g, p, zero = (lists.values.field(i).to_numpy() for i in range(3))
            sizes = np.diff(offsets)
            for lang in set(langs):
                rows = np.flatnonzero((langs == lang) & (sizes > 1))
                # one left entry with all entries of its term, a bounded number of pairs at a time
                left = np.concatenate([np.arange(offsets[r], offsets[r + 1]) for r in rows]) if len(rows) else np.zeros(0, dtype=np.int64)
                start, size = np.repeat(offsets[rows], sizes[rows]), np.repeat(sizes[rows], sizes[rows]).astype(np.int64)
                cuts = np.searchsorted(np.cumsum(size), np.arange(PAIRS, size.sum() + PAIRS, PAIRS))
                for s, e in zip([0, *(cuts + 1)], [*(cuts + 1), len(left)], strict=True):
                    many = size[s:e]
                    if not len(many):
                        continue
                    a = np.repeat(left[s:e], many)
                    b = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(start[s:e], many)
                    a, b = a[a != b], b[a != b]
                    value = f(p[a], p[b]) - f(p[a], zero[b]) - f(zero[a], p[b]) + f(zero[a], zero[b])
                    sums.setdefault(lang, []).append((g[a].astype(np.int64) << 31 | g[b], value))
                    if len(sums[lang]) > 8:
                        compact(lang)
        for lang in sums:
            compact(lang)
            keys, values = sums[lang][0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys >> 31), pa.array(keys & (1 << 31) - 1), pa.array(values)], names=["lang", "g", "h", "value"])

    return entries.mapInArrow(evaluate, "lang string, g long, h long, value long")


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_df: int = MIN_DF, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) group of the documents.

    Part `pair` has a row for each other source of the language, with the sum of `gap` over its
    vocabulary; part `term` has the `top` terms that the group holds beyond the language's share. Null
    text, lang and source count as empty text. A language without a vocabulary has gaps of 0 and no
    terms; an empty table gives no rows. Repeated rows count as documents of their own, ties go to the
    lesser item. Other columns of the input don't matter.
    """
    partial = group_sums(docs, text, lang, source)
    # rows of one term meet once: the sums over documents and the list of its groups need no second shuffle
    sums = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    terms = sums.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("of"))
    terms = materialize(terms.filter((F.col("df") >= min_df) | (F.col("term") == "")), "terms")
    kept = terms.filter("term != ''")
    held = kept.select("lang", "term", "total", F.explode("of").alias("e")).select("lang", "term", "total", "e.source", "e.n")

    found = terms.filter("term = ''").select("lang", F.explode("of.source").alias("source"))
    sizes = held.groupBy("lang", "source").agg(F.sum("n").alias("n_group"), F.count("*").alias("held"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    groups = found.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["n_group", "held", "v", "n_lang"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long")
    total = F.col("n_group") + F.col("v")
    zero = F.when(total > 0, share(F.lit(0).cast("long"), F.greatest(total, F.lit(1))))
    groups = materialize(groups.select("*", number.alias("g"), zero.alias("zero")), "groups")

    shares = held.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), total)).withColumn("q", share(F.col("total"), F.col("n_lang") + F.col("v")))
    shares = materialize(shares.select("lang", "source", "term", "g", "n", "p", "zero", "q"), "shares")
    return _pairs(groups, shares).unionByName(_terms(shares, top))


def _terms(shares: DataFrame, top: int) -> DataFrame:
    """Part `term`: Spark keeps the first `top` of a group in each task before they meet."""
    value = gap(F.col("p"), F.col("q"))
    over = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
    ranked = over.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    return ranked.filter(F.col("rank") <= top)


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """Part `pair`. The gap of g from h over a vocabulary of v terms, from sparse parts:

    v times the gap of two absent terms, for each term of g or of h what it adds if the other group lacks
    it (by the distinct counts of the group, which are few), and for the terms of both the rest.
    """
    own = groups.select("lang", "source", "g", "v", "zero")
    other = groups.select("lang", F.col("source").alias("item"), F.col("g").alias("h"), F.col("zero").alias("other"))
    pairs = own.join(other, "lang").filter("g != h")
    absent = F.when(F.col("v") > 0, F.col("v") * gap(F.col("zero"), F.col("other"))).otherwise(F.lit(0).cast("long"))
    base = pairs.select("lang", "source", "g", "item", "h", absent.alias("base"))

    counts = materialize(shares.groupBy("lang", "g", "p", "zero").agg(F.count("*").alias("m")), "counts")
    rest = groups.select("lang", F.col("g").alias("h"), F.col("zero").alias("other"))
    met = counts.join(rest, "lang").filter("g != h")
    both_absent = lambda a, b: gap(F.col(a), F.col(b))
    of_own = met.select("lang", "g", "h", (F.col("m") * (gap(F.col("p"), F.col("other")) - both_absent("zero", "other"))).alias("value"))
    of_other = met.select("lang", F.col("h").alias("g"), F.col("g").alias("h"), (F.col("m") * (gap(F.col("other"), F.col("p")) - both_absent("other", "zero"))).alias("value"))
    lists = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("g", "p", "zero")).alias("of")).select("lang", "of")
    parts = of_own.unionByName(of_other).unionByName(common_gaps(lists)).groupBy("lang", "g", "h").agg(F.sum("value").alias("more"))
    value = F.col("base") + F.coalesce("more", F.lit(0))
    valued = base.join(parts, ["lang", "g", "h"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    return valued.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
