"""Spelling variants against their plain definition."""

import random
import re
import zlib
from collections import Counter

import pytest

from truegrain.llm import queries as corpus
from truegrain.llm import spelling as module
from truegrain.llm.spelling import spelling_variants
from truegrain.session import load

LOWER = str.maketrans({c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def variants(word):
    """Patterns that two words share if one edit makes one the other: one place open, or one character less."""
    return {word[:i] + "?" + word[i + 1 :] for i in range(len(word))}, {word[:i] + word[i + 1 :] for i in range(len(word))}


def plain(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    open_, less = {}, {}
    for w in n:
        places, shorter = variants(w)
        for p in places:
            open_.setdefault(p, set()).add(w)
        for s in shorter:
            less.setdefault(s, set()).add(w)
    near = {}
    for w in n:
        places, shorter = variants(w)
        near[w] = (set().union(*(open_[p] for p in places)) | less.get(w, set()) | {s for s in shorter if s in n}) - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def answer(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_driver_documents(spark):
    expected = plain([(r.doc_id, r.text) for r in load(spark, "/root/testdata/sf0.01", "documents").collect()])
    got = corpus.op13_spelling_variants(spark, "/root/testdata/sf0.01")
    assert answer(got) == expected and sum(r[1] is not None for r in expected) > 20


@pytest.mark.parametrize("held, partitions", [(module.HELD, "4"), (3, "9")])
def test_chains_ties_and_repeated_letters(spark, monkeypatch, held, partitions):
    """Also in many tasks, whose words share prefixes with those of the task before."""
    monkeypatch.setattr(module, "HELD", held)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get(coalesce)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set(coalesce, "false")
    draw = random.Random(2)
    words = ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "aabbaabb", "aabaabb", "aabbbaabb", "Straßen", "straßenx", "ÀÀÀÀÀÀÀ", "àÀÀÀÀÀÀ", "letters", "letterr", "lettess", "lettters", "leters", "etters", "×÷×÷×÷×÷", "abcdefgh", "abcdefgi", "abcdefgj"]
    rows = []
    for i in range(400):
        rows.append((i % 300, " ".join(draw.choices(words, [3 ** (k % 7) for k in range(len(words))], k=30))))
    rows += [(None, "letters LETTERS"), (1, None), (2, ""), (3, "12 -- 漢字"), (4, "wordsagain1wordsagain"), (5, "o" * 20_000 + " " + "o" * 20_000 + " " + "o" * 19_999 + "-" + "o" * 19_999)]
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int")
    assert answer(spelling_variants(docs)) == plain(rows)
    spark.conf.set("spark.sql.shuffle.partitions", before[0])
    spark.conf.set(coalesce, before[1])


def test_empty_table(spark):
    assert spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
