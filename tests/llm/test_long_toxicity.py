"""Toxicity of texts of 100,000 characters and more: the score follows what a text says, not how long it is."""

import random

from truegrain.llm.toxicity import learn_toxicity


def test_long_texts_are_told_apart(spark, documents):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(3, 9)))
    marked = [[word() for _ in range(200)] for _ in range(2)]
    write = lambda toxic, n: " ".join(rnd.choice(marked[toxic]) if rnd.random() < 0.3 else word() for _ in range(n))
    rows = [(i, write(i % 4 == 0, 80)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model = learn_toxicity(documents(rows), labels)
    for size in (100, 16_000, 60_000):
        texts = [write(toxic, size) for toxic in (1, 1, 1, 0, 0, 0)]
        assert size == 100 or min(map(len, texts)) >= 100_000
        assert [score >= 0.5 for score in model.scores(texts)] == [True] * 3 + [False] * 3, size
