"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios (operator 6)."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.llm.common import bitmap, carried, class_sample, fold, in_bitmap
from truegrain.llm.ngrams import buckets, letter_table, letters_of
from truegrain.session import materialize

#: So many buckets that the n-grams of a text of 100,000 characters leave most of them free.
ORDERS, BITS = (3, 4, 5, 6), 22
#: Buckets whose counts a task sends together.
PART = 1 << 16
#: Labelled rows, about as many of either class as there are, that give the log-count ratios, and those of them
#: that the linear weights are fitted on. A hash of the key chooses them before any text moves.
LABELLED, SAMPLE = 40_000, 16_000
#: A feature takes part if this many labelled documents have it and its log-count ratio is so far from 0.
LEAST, RATIO = 4, 1.0


def spread(used, values):
    """A table of 2^BITS numbers from those of its used buckets."""
    import numpy as np

    table = np.zeros(1 << BITS, dtype=np.float32)
    table[used] = values
    return table


@dataclass
class ToxicityModel:
    """weights[i] and ratios[i] belong to bucket used[i]; other buckets take no part."""

    used: Any
    weights: Any
    ratios: Any
    bias: float
    tables: Any = field(default=None, compare=False)

    def scores(self, texts):
        """Probability that each text is toxic; null, empty and letterless texts have the score of the bias.

        A text is the vector of the ratios of its buckets at length 1, so its score does not follow its length.
        """
        import numpy as np

        # once a task, to which the model is sent without them
        self.tables = self.tables or (letter_table(), spread(self.used, self.ratios), spread(self.used, self.weights * self.ratios))
        letters, ratio, table = self.tables
        for text in texts:
            found = present(text, letters, ratio)
            size = np.sqrt(np.square(ratio[found], dtype=np.float64).sum())
            logit = float(table[found].sum(dtype=np.float64)) / size if size else 0.0
            yield 1 / (1 + np.exp(-np.clip(logit + self.bias, -500.0, 500.0)))


def present(text, letters, ratio=None):
    """The buckets that occur in a text, once each; with `ratio` only those whose ratio is not 0."""
    import numpy as np

    points = letters_of(text or "", letters)
    hits = list(buckets(points, ORDERS, BITS)) if len(points) > 2 else []
    hits = hits if ratio is None else [b[ratio[b] != 0] for b in hits]
    return np.unique(np.concatenate(hits)) if hits else np.zeros(0, dtype=np.int64)


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(_text, _label) of the labelled documents. Only documents whose key is in the bitmap of labelled keys are shuffled.

    A key with several labels is toxic if one of them says so; null keys, texts and labels teach nothing.
    """
    marks = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("_k")).agg(F.max(label).cast("int").alias("_label"))
    marks = materialize(marks, "marks")
    words = materialize(bitmap(marks.select(F.xxhash64("_k").alias("_h")), "_h"), "bitmap")
    rows = docs.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(key).alias("_h"))
    return in_bitmap(rows, "_h", words).filter("_hit").join(marks, F.col("_key") == F.col("_k")).select("_key", "_text", "_label")


def log_count_ratios(rows: DataFrame):
    """(used, ratios): the buckets that take part and their ratios, from rows of (_text, _label).

    Each task adds up the documents that hold a bucket and sends its counts packed, a row for each
    PART buckets; the driver gets a row for each of the 2^BITS buckets at most, whatever the input.
    """
    import zlib

    import numpy as np

    def count(batches):
        import pyarrow as pa

        letters, n = letter_table(), np.zeros((2, 1 << BITS), dtype=np.int32)
        for batch in batches:
            for text, label in zip(batch.column("_text"), batch.column("_label").to_pylist(), strict=True):
                n[label, present(text.as_py(), letters)] += 1
        for part in range(0, 1 << BITS, PART):
            own = n[:, part : part + PART]
            if own.any():
                # in the least width that holds the counts; most are 0, so they pack well
                width = np.min_scalar_type(int(own.max())).newbyteorder("<")
                body = zlib.compress(own.astype(width).tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([width.itemsize], pa.int32()), pa.array([body], pa.binary())], names=["part", "width", "body"])

    def add(batches):
        import pyarrow as pa

        totals: dict[int, Any] = {}
        for batch in batches:
            for part, width, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held = totals.setdefault(part, np.zeros((2, PART), dtype=np.int64))
                held += np.frombuffer(zlib.decompress(body), f"<u{width}").reshape(2, PART)
        for part, n in totals.items():
            at = np.flatnonzero(n.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array((at + part).astype(np.int32)), pa.array(n[0, at]), pa.array(n[1, at])], names=["b", "n0", "n1"])

    packed = rows.select("_text", "_label").mapInArrow(count, "part int, width int, body binary")
    sums = packed.repartition("part").mapInArrow(add, "b int, n0 long, n1 long")
    sums = materialize(sums, "ngrams")
    # each bucket that occurs counts once more in either class
    kinds, *totals = sums.agg(F.count("*"), F.coalesce(F.sum("n0"), F.lit(0)), F.coalesce(F.sum("n1"), F.lit(0))).first()
    of_class = [F.log((F.col(f"n{c}") + 1) / F.lit(float(totals[c] + kinds))) for c in (0, 1)]
    taken = sums.filter(F.col("n0") + F.col("n1") >= LEAST).select("b", (of_class[1] - of_class[0]).alias("r")).filter(F.abs("r") >= RATIO).toArrow()
    used = taken.column(0).to_numpy().astype(np.int32)
    order = np.argsort(used)
    return used[order], taken.column(1).to_numpy().astype(np.float32)[order]


def fit_weights(offsets, columns, labels, weights, ratios, steps: int = 300, l2: float = 1e-4):
    """Weights and bias of a logistic regression on texts of length 1, by Adam over the whole sample.

    `columns` are places in `ratios`; text i has those from offsets[i] to offsets[i + 1].
    """
    import numpy as np

    rows = np.repeat(np.arange(len(labels), dtype=np.int32), np.diff(offsets))
    sizes = np.sqrt(np.bincount(rows, np.square(ratios[columns], dtype=np.float64), len(labels)))
    scale = 1 / np.where(sizes > 0, sizes, 1.0)
    w, bias, total = np.zeros(len(ratios)), 0.0, weights.sum()
    first, second = np.zeros(len(ratios) + 1), np.zeros(len(ratios) + 1)
    for t in range(1, steps + 1):
        z = np.bincount(rows, (w * ratios)[columns], len(labels)) * scale + bias
        wrong = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels) * weights / total
        slope = np.append(np.bincount(columns, (wrong * scale)[rows], len(ratios)) * ratios + l2 * w, wrong.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def learn_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """Fit on labelled documents: log-count ratios over about LABELLED of them, linear weights over about SAMPLE.

    A sample has as many rows of either class as there are; weights restore the classes' shares.
    Without rows of both classes the model gives every text the share of toxic ones (0.5 if there are no labels).
    """
    import numpy as np

    marked = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key)).agg(F.max(label).cast("int").alias(label))
    marks, shares = class_sample(materialize(marked, "labels"), label, LABELLED, F.col(key))
    marks = materialize(marks, "labels")
    rows = materialize(labelled(docs, marks, key, text, label).select("_key", "_label"), "labelled")
    chosen, counts = class_sample(rows, "_label", SAMPLE, F.lit("weights"), F.col("_key"))
    total = sum(counts.values())
    if len(counts) < 2:
        share = (counts.get(1, 0) + 0.5) / (total + 1) if total else 0.5
        return ToxicityModel(np.zeros(0, dtype=np.int32), np.zeros(0), np.zeros(0), float(np.log(share / (1 - share))))
    used, ratios = log_count_ratios(labelled(docs, marks, key, text, label))

    def features(batches):
        import pyarrow as pa

        letters, ratio = letter_table(), spread(used, ratios)
        for batch in batches:
            hits = [present(t.as_py(), letters, ratio).astype("<i4").tobytes() for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([batch.column("_label"), pa.array(hits, pa.binary())], names=["_label", "hits"])

    chosen = materialize(chosen.select(F.col("_key").alias(key), F.col("_label").alias(label)), "sample")
    sample = labelled(docs, chosen, key, text, label).select("_label", "_text").mapInArrow(features, "_label int, hits binary").toArrow()
    y = sample.column(0).to_numpy().astype(np.float64)
    hits = [np.frombuffer(h.as_py(), "<i4") for h in sample.column(1)]
    offsets = np.concatenate([[0], np.cumsum([len(h) for h in hits])]).astype(np.int64)
    of_class = np.array([max(1, (y == c).sum()) for c in (0, 1)])
    weights = np.array([shares[0] / of_class[0], shares[1] / of_class[1]])[y.astype(int)]
    columns = np.searchsorted(used, np.concatenate(hits)).astype(np.int32)
    linear, bias = fit_weights(offsets, columns, y, weights, ratios)
    return ToxicityModel(used, linear.astype(np.float32), ratios, bias)


def toxicity_score(model: ToxicityModel):
    """A column function text -> score; the model is sent as its used buckets."""

    @F.arrow_udf("double")
    def score(texts):
        import numpy as np
        import pyarrow as pa

        return pa.array(np.fromiter(model.scores(t.as_py() for t in texts), dtype=np.float64), pa.float64())

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every document; rows whose fold is `held` teach nothing.

    Scores see the text only. An empty table gives no rows; repeated rows each have their score.
    """
    model = learn_toxicity(docs.filter(fold(key, folds) != held), labels.filter(fold(key, folds) != held), key, text)
    scored = docs.select(F.col(key), (fold(key, folds) == held).alias("held_out"), toxicity_score(model)(F.col(text)).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def drop_toxic(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with a score under 0.5, with all their columns; null, empty and letterless texts have the bias's score.

    An empty table gives no rows; repeated rows stay or go together.
    """
    model = learn_toxicity(docs.filter(fold(key, folds) != held), labels.filter(fold(key, folds) != held), key, text)
    return carried(docs, key, text).filter(toxicity_score(model)(F.col("_text")) < 0.5).select("_row.*")
