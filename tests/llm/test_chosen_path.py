"""The chosen-path join against all pairs."""

import random

import pytest

from truegrain.llm import chosen_path as module
from truegrain.llm import queries as corpus
from truegrain.llm.chosen_path import similar_documents
from truegrain.session import load


def shingles(text):
    words = (text or "").encode().lower().split()
    width = min(3, len(words))
    return {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def plain(rows):
    """Rows (doc_id, n_shingles, component_id, kept) by all pairs of distinct sets."""
    sets = [frozenset(shingles(t)) for _, t in rows]
    distinct = list({s for s in sets if s})
    above = list(range(len(distinct)))

    def root(i):
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    for i, a in enumerate(distinct):
        for j in range(i):
            b = distinct[j]
            if min(len(a), len(b)) * 100 >= max(len(a), len(b)) * 85 and 100 * len(a & b) >= 85 * len(a | b):
                above[root(i)] = root(j)
    at = {s: root(i) for i, s in enumerate(distinct)}
    least = {}
    for (key, _), s in zip(rows, sets, strict=True):
        if s and key is not None:
            least[at[s]] = min(key, least.get(at[s], key))
    of = [least.get(at[s]) if s else key for (key, _), s in zip(rows, sets, strict=True)]
    return sorted(((k, len(s), c, k == c) for (k, _), s, c in zip(rows, sets, of, strict=True)), key=str)


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def edited(draw, words, share):
    return [draw.choice("abcdefgh") * 3 + str(draw.randrange(99)) if draw.random() < share else w for w in words]


def test_driver_documents(spark):
    docs = load(spark, "/root/testdata/sf0.001", "documents")
    expected = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert answer(corpus.op12_chosen_path(spark, "/root/testdata/sf0.001")) == expected


@pytest.mark.parametrize("small, work, depth", [(1024, 4096, 12), (16, 0, 4)])
def test_templates_and_near_copies(spark, monkeypatch, small, work, depth):
    """Groups around the threshold, more than a node compares at once, and the last depth in blocks."""
    for name, value in (("SMALL", small), ("WORK", work), ("DEPTH", depth)):
        monkeypatch.setattr(module, name, value)
    draw = random.Random(7)
    vocabulary = [f"word{i}" for i in range(500)]
    rows = []
    for _ in range(4):
        base = draw.choices(vocabulary, k=120)
        for share in (0.005, 0.01, 0.02, 0.03, 0.05):
            rows += [" ".join(edited(draw, base, share)) for _ in range(12)]
    rows += [" ".join(draw.choices(vocabulary, k=60)) for _ in range(40)]
    rows = list(enumerate(rows))
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(similar_documents(docs)) == plain(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 7001} x{i % 13}" for i in range(100_000))
    rows = [(5, None), (4, ""), (3, " \t\n"), (9, "One"), (8, "one"), (7, "one two"), (6, "ONE\ttwo"), (2, "one  two three"), (1, "one two three"), (1, "one two three"), (None, "one two three"), (None, "all alone here"), (12, long), (11, long + " end"), (13, "  one"), (14, None)]
    docs = spark.createDataFrame([(*r, 1, "s", 2) for r in rows], "doc_id long, text string, set int, size string, node int")
    assert answer(similar_documents(docs)) == plain(rows)


def test_empty_table(spark):
    assert similar_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_trees_reach_the_target():
    assert (1 - 0.85**module.START) ** module.trees() <= 1 - module.RECALL < (1 - 0.85**module.START) ** (module.trees() - 1)
