"""Documents keep their columns through every stage that returns documents, whatever the columns are called."""

import pytest

from truegrain.llm.exact_dedup import drop_copies
from truegrain.llm.mixing import mixed_documents
from truegrain.llm.simhash import drop_near_copies
from truegrain.llm.toxicity import drop_toxic

NAMES = """_id _digest _group _hash _hit _row _text _of _size _source _draw _word _mask _bit _at _both _lid _ldigest _drop _best _n
_body _length _place _set _bands _band _first _root _low _high _from _total _target _rate _turn _copies _copy _score _key _k _h _label
node root a b u v m part local score hits text_hash keep_id kept size set own.name own`tick""".split()


@pytest.fixture
def wide(spark):
    names = [n for n in NAMES if "`" not in n]
    texts = {1: "one two three four five six", 2: "One two three four five six", 3: "a b c d e f g h i j k l m n o p", 4: "a b c d e f g h i j k l m n o p q", 5: None, 6: "alone here " * 30}
    rows = [(i, t, "en", "s", *(f"{n} of {i}" for n in names)) for i, t in texts.items()]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame(rows, schema)


def toxic(docs):
    labels = docs.sparkSession.createDataFrame([(i, i % 2) for i in range(1, 7)], "doc_id long, toxic int")
    return drop_toxic(docs, labels)


@pytest.mark.parametrize("stage", [drop_copies, drop_near_copies, mixed_documents, toxic])
def test_columns_survive(wide, stage):
    before = {r.doc_id: tuple(r) for r in wide.collect()}
    after = stage(wide)
    assert after.schema.names == wide.schema.names
    rows = after.collect()
    assert all(tuple(r) == before[r.doc_id] for r in rows)
    if stage is drop_copies:
        assert sorted(r.doc_id for r in rows) == [2, 3, 4, 5, 6]
    if stage is drop_near_copies:
        assert sorted(r.doc_id for r in rows) == [1, 3, 5, 6]
