"""Language by sparse multinomial logistic regression on TF-IDF of character n-grams (operator 3)."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.llm.common import class_sample, fold
from truegrain.llm.ngrams import buckets, letter_table, letters_of

ORDERS, BITS = (1, 2, 3), 15
#: Labelled rows that the model is fitted on, spread over the languages; document frequencies come from all of them.
SAMPLE = 6_000
UNKNOWN = "und"


def term_counts(text, letters):
    """Counts by bucket of a text's n-grams; None for a text without letters."""
    import numpy as np

    points = letters_of(text or "", letters)
    if len(points) <= 2:
        return None
    n = np.zeros(1 << BITS, dtype=np.int64)
    for b in buckets(points, ORDERS, BITS):
        n += np.bincount(b, minlength=1 << BITS)
    return n


def tf_idf(counts, idf):
    """Buckets and their values: (1 + log count) times inverse document frequency, scaled to length 1."""
    import numpy as np

    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    return at, values / np.sqrt((values**2).sum())


@dataclass
class LanguageModel:
    languages: list[str]
    idf: Any
    weights: Any
    temperature: float = 1.0
    bias: Any = field(default=0.0)

    def predict(self, texts):
        """Lists of language and calibrated probability; `und` and 0.0 without a letter or without learned languages."""
        import numpy as np

        letters, names, scores = letter_table(), [], []
        for text in texts:
            counts = term_counts(text, letters) if self.languages else None
            if counts is None:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            at, values = tf_idf(counts, self.idf)
            p = softmax(((values @ self.weights[at] + self.bias) / self.temperature)[None])[0]
            names.append(self.languages[int(p.argmax())])
            scores.append(float(min(1.0, p.max())))
        return names, np.array(scores, dtype=np.float64)


def softmax(z):
    import numpy as np

    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def document_frequencies(texts: DataFrame):
    """Documents and, for each bucket, documents that hold it, over all rows of (_text). The driver gets 2^BITS rows at most."""
    import numpy as np

    def count(batches):
        import pyarrow as pa

        letters, n = letter_table(), np.zeros((1 << BITS) + 1, dtype=np.int64)  # the last counts documents
        for batch in batches:
            for text in batch.column(0):
                points = letters_of(text.as_py() or "", letters)
                if len(points) > 2:
                    seen = np.zeros(1 << BITS, dtype=bool)
                    for b in buckets(points, ORDERS, BITS):
                        seen[b] = True
                    n[:-1] += seen
                    n[-1] += 1
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["b", "n"])

    sums = texts.mapInArrow(count, "b long, n long").groupBy("b").agg(F.sum("n")).toArrow()
    n = np.zeros((1 << BITS) + 1)
    n[sums.column(0).to_numpy()] = sums.column(1).to_numpy()
    return n[-1], n[:-1]


def follow_regularised_leader(rows, labels, classes: int, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4, seed: int = 7):
    """Weights (2^BITS, classes) and bias of a multinomial logistic regression, by FTRL-proximal with elastic net.

    Each row updates the features it holds: z collects gradients less the shift that adaptive rates
    make, n their squares; a weight is 0 while |z| <= l1.
    """
    import numpy as np

    z, n = np.zeros(((1 << BITS) + 1, classes)), np.zeros(((1 << BITS) + 1, classes))
    last = 1 << BITS

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(z[at]) <= l1, 0.0, w)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, values = np.append(rows[i][0], last), np.append(rows[i][1], 1.0)
            w = weights(at)
            p = softmax((values @ w)[None])[0]
            p[labels[i]] -= 1
            g = values[:, None] * p[None, :]
            rate = (np.sqrt(n[at] + g**2) - np.sqrt(n[at])) / alpha
            z[at] += g - rate * w
            n[at] += g**2
    w = weights(np.arange(last + 1))
    return w[:-1], w[-1]


def fit_temperature(logits, labels) -> float:
    """The temperature with the least log loss, by golden section over its logarithm."""
    import numpy as np

    if not len(labels):
        return 1.0

    def loss(t):
        p = softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, step = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - step * (high - low), low + step * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def learn_language(rows: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> LanguageModel:
    """Fit on rows with a label and a text; four fifths of the sample give the weights, one fifth the temperature.

    Document frequencies cover every learning row, the weights about SAMPLE of them, as many of each
    language as there are. Without such rows the model answers `und`.
    """
    import numpy as np

    rows = rows.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    total, frequencies = document_frequencies(rows.select(text))
    idf = np.log((1 + total) / (1 + frequencies)) + 1

    def features(batches):
        import pyarrow as pa

        letters = letter_table()
        for batch in batches:
            names, folds, terms = [], [], []
            for name, part, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                counts = term_counts(value.as_py(), letters)
                if counts is not None:
                    at = np.flatnonzero(counts)
                    names.append(name)
                    folds.append(part)
                    terms.append((at.astype("<u2").tobytes(), counts[at].astype("<i8").tobytes()))
            columns = [pa.array(names, pa.string()), pa.array(folds, pa.int64()), pa.array([t[0] for t in terms], pa.binary()), pa.array([t[1] for t in terms], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "fold", "at", "n"])

    chosen, _ = class_sample(rows, label, SAMPLE, F.col(key), F.xxhash64(text))
    part = F.pmod(F.xxhash64(F.lit("calibration"), F.col(key), F.col(text)), F.lit(5))
    sample = chosen.select(F.col(label).cast("string"), part, F.col(text)).mapInArrow(features, "lang string, fold long, at binary, n binary").toArrow().to_pylist()
    languages = sorted({r["lang"] for r in sample})
    if not languages:
        return LanguageModel([], idf, np.zeros((1 << BITS, 0)))

    def vector(r):
        counts = np.zeros(1 << BITS, dtype=np.int64)
        counts[np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["n"], "<i8")
        return tf_idf(counts, idf)

    sample.sort(key=lambda r: (r["lang"], r["at"], r["n"]))
    fit = [r for r in sample if r["fold"]] if any(r["fold"] for r in sample) else sample
    held = [r for r in sample if not r["fold"]]
    place = {name: i for i, name in enumerate(languages)}
    weights, bias = follow_regularised_leader([vector(r) for r in fit], [place[r["lang"]] for r in fit], len(languages))
    logits = np.array([v @ weights[at] + bias for at, v in map(vector, held)]).reshape(-1, len(languages))
    temperature = fit_temperature(logits, np.array([place[r["lang"]] for r in held], dtype=int))
    return LanguageModel(languages, idf.astype(np.float32), weights.astype(np.float32), temperature, bias)


def predict_language(docs: DataFrame, folds: int = 4, held: int = 2, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """(key, held_out, lang_pred, score) of every document, from its text alone.

    Rows whose fold is `held` teach nothing. Null texts and texts without a letter are `und` with
    score 0; ties go to the language that sorts first.
    """
    model = learn_language(docs.filter(fold(key, folds) != held), key, text, label)
    kind = docs.schema[key].dataType.simpleString()

    def predict(batches):
        import pyarrow as pa

        for batch in batches:
            names, scores = model.predict(t.as_py() for t in batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores)], names=[key, "held_out", "lang_pred", "score"])

    asked = docs.select(F.col(key), (fold(key, folds) == held).alias("held_out"), F.col(text))
    return asked.mapInArrow(predict, f"`{key}` {kind}, held_out boolean, lang_pred string, score double")
