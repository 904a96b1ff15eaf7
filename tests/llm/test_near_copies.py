"""The near-copy stage against all pairs of shingle sets, from a similarity of 0.8 to 1."""

import random

from truegrain.llm.simhash import drop_near_copies


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_stage_links_all_pairs_at_four_fifths_and_no_others(documents):
    rnd, texts = random.Random(11), {}
    for base in range(60):
        words = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice((40, 120, 400)))]
        texts[base * 10] = " ".join(words)
        for copy in range(1, 4):
            other = list(words)
            for at in rnd.sample(range(len(words)), rnd.randint(1, max(1, len(words) // 30))):
                other[at] = f"x{rnd.randrange(5000)}"
            texts[base * 10 + copy] = " ".join(other)
    sets, least, near = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}, 0
    for _ in range(4):
        near = 0
        for a in texts:
            for b in range(a // 10 * 10, a):
                if b in texts and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                    near += 1
                    least[a] = least[b] = min(least[a], least[b])
    assert near >= 30 and any(least[i] == i for i in texts if i % 10)
    kept = [r.doc_id for r in drop_near_copies(documents([*texts.items()])).collect()]
    assert sorted(kept) == sorted(i for i in texts if least[i] == i)


def test_a_similarity_of_just_four_fifths_counts(documents):
    words = [f"w{i}" for i in range(40)]  # 36 shingles; 4 shared of 5 with 32 in common and 40 in all
    texts = [(1, " ".join(words)), (2, " ".join([*words[:36], "a", "b", "c", "d"])), (3, " ".join([*words[:35], "e", "f", "g", "h", "i"]))]
    assert [10 * len(shingles(texts[0][1]) & shingles(t)) >= 8 * len(shingles(texts[0][1]) | shingles(t)) for _, t in texts[1:]] == [True, False]
    assert sorted(r.doc_id for r in drop_near_copies(documents(texts[:2])).collect()) == [1]
    assert sorted(r.doc_id for r in drop_near_copies(documents([texts[0], texts[2]])).collect()) == [1, 3]


def test_fingerprints_propose_pairs_that_the_shingle_sets_confirm(documents, monkeypatch):
    from truegrain.llm import near_copies
    from truegrain.llm.simhash import fingerprint_pairs, simhash

    words = [f"w{i}" for i in range(400)]
    texts = {1: " ".join(words), 2: " ".join([*words, "x"]), 3: " ".join(f"v{i}" for i in range(400))}
    assert (simhash(texts[1]) ^ simhash(texts[2])).bit_count() <= 2 < (simhash(texts[1]) ^ simhash(texts[3])).bit_count()
    rows = near_copies.sketches(documents([*texts.items()]), "doc_id", "text", simhash)
    sets = {r._id: r._set for r in rows.collect()}
    assert [{r.a, r.b} for r in fingerprint_pairs(rows).collect()] == [{sets[1], sets[2]}]
    # without a band in common the fingerprints alone still tie the copies
    monkeypatch.setattr(near_copies, "band_keys", lambda hashes, *_: hashes[:1].view("i8") ^ len(hashes))
    assert sorted(r.doc_id for r in drop_near_copies(documents([*texts.items()])).collect()) == [1, 3]
