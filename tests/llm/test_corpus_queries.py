"""The corpus queries over the smallest driver tables: against their SQL, or against plain versions of their definition."""

import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tools.verify import TABLES, rows_of
from truegrain.llm import queries as corpus
from truegrain.session import load

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no driver tables")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r for r in load(spark, DATA, "documents").collect()}


@pytest.mark.parametrize("name", sorted(corpus.ORACLES))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    df = entry.queries()[name](spark, DATA)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(corpus.ORACLES[name])
    assert got == rows_of([c[0] for c in cursor.description], cursor.fetchall())


def test_all_operators_are_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names


def test_language_of_held_out_documents(spark, texts):
    rows = corpus.op3_language(spark, DATA).collect()
    assert len(rows) == len(texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and texts[r.doc_id].lang]
    assert sum(r.lang_pred == texts[r.doc_id].lang for r in held) >= 0.9 * len(held)


def test_packing_is_a_whole_and_tight_round_trip(spark, texts):
    from tokenizers import Tokenizer

    from truegrain.llm.tokens import tokenizer_path

    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in corpus.op4_packing(spark, DATA).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for i, of in pieces.items():
        ids = [*tokenizer.encode(texts[i].text or "", add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(of, key=lambda r: r.start):
            data = b"".join(x.to_bytes(4, "little") for x in ids[at : at + r.length])
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(data))
            at += r.length
        assert at == len(ids)
    for of in sequences.values():
        at = 0
        for r in sorted(of, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    total = sum(r.length for of in sequences.values() for r in of)
    assert len(sequences) <= 1.1 * total / 4096 + 1


def test_shards_by_the_definition(spark, texts):
    rows = corpus.op5_sharding(spark, DATA).collect()
    slots = defaultdict(list)
    for r in rows:
        body = (texts[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(body) + 1, zlib.crc32(body), "key")
        assert r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_toxicity_rows_and_folds(spark, texts):
    rows = corpus.op6_toxicity(spark, DATA).collect()
    toxic = {r.doc_id: r.toxic for r in load(spark, DATA, "labels").collect()}
    assert len(rows) == len(texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in rows)
    seen = [r for r in rows if not r.held_out and toxic.get(r.doc_id) is not None]
    assert sum(r.predicted == toxic[r.doc_id] for r in seen) >= 0.9 * len(seen)


def test_simhash_components_by_brute_force(spark, texts):
    import xxhash

    prints = {}
    for i, row in texts.items():
        words = (row.text or "").encode().lower().split()
        shingles = [b" ".join(words[j : j + 3]) for j in range(max(1, len(words) - 2))] if words else []
        ones = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s, 42) >> b & 1)
        prints[i] = sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))
    component = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if component[b] < component[a] and (prints[a] ^ prints[b]).bit_count() <= 2:
                    component[a], changed = component[b], True
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in corpus.op8_simhash(spark, DATA).collect()}
    assert got == {i: (f"{p:016x}", component[i]) for i, p in prints.items()}


def test_surrogates_leave_no_entity_and_agree(spark, texts):
    from truegrain.llm.pii import canonical, find

    made, back = {}, {}
    rows = corpus.op7_surrogates(spark, DATA).collect()
    assert len(rows) == len(texts)
    for r in rows:
        before = texts[r.doc_id].text
        for e in r.entities:
            original = before[e.start : e.start + e.length]
            assert e.kind == "phone" or original not in r.text
            name = (e.kind, canonical(e.kind, original))
            assert made.setdefault(name, canonical(e.kind, e.surrogate)) == canonical(e.kind, e.surrogate)
            assert back.setdefault((e.kind, made[name]), name) == name
        assert [e.kind for e in r.entities] == [k for _, _, k in find(before)]
    assert {"email", "ip", "phone"} <= {k for k, _ in made}


def test_packed_rows_round_trip(spark, texts):
    import numpy as np

    from truegrain.llm.tokens import byte_pairs, tokenizer_path

    tokenizer, pieces = byte_pairs(tokenizer_path("byte_bpe_50k.tiktoken")), defaultdict(dict)
    for r in corpus.op9_packed_ids(spark, DATA).collect():
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == 4096 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.used <= 4096
        assert r.resets == [c for c in r.cu_seqlens if c < 4096] and (ids[r.used :] == 50256).all()
        for i, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            pieces[i][start] = ids[a:b].tolist()
    for i, row in texts.items():
        assert (ids := sum((pieces[i][s] for s in sorted(pieces[i])), [])) == [*tokenizer.encode_ordinary(row.text or ""), 50256]
        assert tokenizer.decode(ids[:-1]) == (row.text or "")


def near_survivors(texts):
    """The least key of each connected part of the texts, tied by a Jaccard similarity of 0.8 in five-word shingles; all pairs."""
    sets, above = {}, {i: i for i in texts}
    for i, text in texts.items():
        words = (text or "").encode().lower().split()
        width = min(5, len(words))
        sets[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if words else {()}

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    keys = sorted(texts)
    for n, a in enumerate(keys):
        for b in keys[:n]:
            if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                above[high] = low
    return {root(i) for i in keys}


def test_pipeline_keeps_what_its_stages_keep(spark):
    """Each stage on its own input, by the plain definition of what it keeps."""
    import corpus_pipeline
    from truegrain.session import materialize

    docs, columns = load(spark, DATA, "documents"), load(spark, DATA, "documents").columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, DATA), name)
        assert docs.columns == columns
        rows = before.collect()
        kept[name] = [r.doc_id for r in docs.collect()]
        if name == "exact_dedup":
            best = {}
            for r in rows:
                text = (r.text or "").encode().lower()
                best[text] = max(best.get(text, -1), r.doc_id)
            assert sorted(kept[name]) == sorted(best.values())
        elif name == "simhash_near_dedup":
            assert sorted(kept[name]) == sorted(near_survivors({r.doc_id: r.text for r in rows}))
        elif name == "mix_sources":
            from truegrain.llm.mixing import mix_report

            assert Counter(kept[name]) == Counter({r.doc_id: r.copies for r in mix_report(before).collect() if r.copies})
        else:
            assert set(kept[name]) <= {r.doc_id for r in rows}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert Counter(r.doc_id for r in packed.filter("start = 0").collect()) == Counter(kept["mix_sources"])
