"""The divergence audit against its plain definition, on odd rows."""

import random
import re
from collections import Counter, defaultdict

import pytest

from truegrain.llm import divergence as module
from truegrain.llm.divergence import divergence

LOWER = str.maketrans({c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def plain(rows, min_df=3, top=200):
    """{(lang, source, part, item): (value, rank)} from (lang, source, text)."""
    rows = [((g or ""), (s or ""), Counter(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate(LOWER)))) for g, s, t in rows]
    out = {}
    for lang in {g for g, _, _ in rows}:
        df = Counter(t for g, _, words in rows if g == lang for t in words)
        kept = [t for t, n in df.items() if n >= min_df]
        counts, of_lang = defaultdict(Counter), Counter()
        for g, s, words in rows:
            if g == lang:
                counts[s].update({t: words[t] for t in kept if t in words})
                of_lang.update({t: words[t] for t in kept if t in words})

        def shares(n):
            total = sum(n.values()) + len(kept)
            return {t: 1 + 10**9 * (n[t] + 1) // total for t in kept}

        q = shares(of_lang)
        p = {s: shares(counts[s]) for s in counts}
        for s in counts:
            pair = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != s]
            term = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, values, most in (("pair", pair, len(pair)), ("term", term, top)):
                for rank, (value, item) in enumerate(sorted(values, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out[lang, s, part, item] = (value, rank)
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, s, "n", "p") for i, (g, s, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n string, p string")


def answer(df):
    return {(r.lang, r.source, r.part, r.item): (r.value, r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("held, pairs", [(module.HELD, module.PAIRS), (3, 5)])
def test_equals_the_definition(spark, monkeypatch, held, pairs):
    monkeypatch.setattr(module, "HELD", held)
    monkeypatch.setattr(module, "PAIRS", pairs)
    draw = random.Random(3)
    words = ["Haus", "haus", "Éa", "éa", "x", "été!", "don't", "漢字", "a1b", "zz"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(draw.choice(["en", "fr", None]), draw.choice(["s0", "s1", "s2", "", None]), " ".join(draw.choices(words, k=draw.randrange(30)))) for _ in range(120)]
    rows += [("en", "s0", None), ("en", "s9", ""), ("en", "s8", "123 456"), ("de", "only", "Haus Haus Haus"), ("de", "two", None), ("it", "s0", None)]
    rows += [("en", "s1", "Haus zz " * 5000)] * 3 + [("es", "equal", "uno dos")] * 3 + [("es", "alike", "uno dos")] * 3
    expected = plain(rows)
    assert answer(divergence(table(spark, rows))) == expected
    assert {k[2] for k in expected} == {"pair", "term"}


def test_top_and_ties(spark):
    rows = [("en", "a", f"{chr(97 + i)}{chr(97 + j)} rest") for i in range(6) for j in range(6) for _ in range(3)] + [("en", "b", "rest")] * 9
    got = answer(divergence(table(spark, rows), top=4))
    assert got == plain(rows, top=4)
    assert [k[3] for k, v in sorted(got.items(), key=lambda kv: kv[1][1]) if k[1:3] == ("a", "term")] == ["aa", "ab", "ac", "ad"]


def test_empty_table(spark):
    assert divergence(table(spark, [])).collect() == []
