"""Quality by naive Bayes support vectors over byte n-gram indicators.

Each text is the set of its hashed byte n-grams, and of a few marks of its form:
length class, share of distinct words, whether words follow themselves. Spark counts in how many
labelled texts of either class each occurs. Indicators are scaled by the log ratio
of the class counts, and a linear hinge-loss model is fitted to them by dual
coordinate descent. Counts and fit take bounded samples of the labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzeflow.llm.toxicity import labelled_ids, labelled_sample, sampled_ids


#: Last buckets, kept for the marks of form.
_FORM = 48


@dataclass(frozen=True)
class Settings:
    """N-gram lengths, hash bits, smoothing, weight of form, hinge cost, epochs.

    At most count_rows labelled rows of each class give the class counts, at most sample_rows of
    them fit the weights: those with the smallest hashes of their id.
    """

    grams: tuple[int, ...] = (3, 4)
    hash_bits: int = 17
    smoothing: float = 1.0
    form: float = 0.5
    cost: float = 1.0
    epochs: int = 12
    count_rows: int = 20_000
    sample_rows: int = 3000
    cut: float = 0.3


@dataclass(frozen=True)
class Model:
    """Weight of each n-gram's presence; slope and offset of the score."""

    settings: Settings
    weights: np.ndarray
    slope: float
    offset: float

    def score(self, text: str | None) -> float:
        found = features(text, self.settings)
        margin = float(self.weights[found] @ _scale(found, self.settings))
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -40, 40))))


def features(text: str | None, settings: Settings) -> np.ndarray:
    """Sorted distinct buckets of a text's byte n-grams and form; digits count as one byte value."""
    raw = (text or "").encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    data = np.where((data >= 48) & (data <= 57), 48, data).astype(np.uint32)
    seen = np.zeros(1 << settings.hash_bits, dtype=bool)
    for size in settings.grams:
        count = max(0, len(data) - size + 1)
        code = np.full(count, size, dtype=np.uint32)
        for i in range(size):
            code = code * np.uint32(0x01000193) + data[i : i + count]
        code *= np.uint32(0x9E3779B1)
        seen[code >> np.uint32(32 - settings.hash_bits)] = True
    words = raw.split()
    again = sum(map(bytes.__eq__, words, words[1:]))
    form = len(seen) - _FORM
    seen[form:] = False
    seen[form + min(15, len(words).bit_length())] = True
    seen[form + 16 + (15 * len(set(words))) // max(1, len(words))] = True
    seen[form + 32 + (15 * again) // max(1, len(words))] = True
    return np.flatnonzero(seen)


def _scale(found: np.ndarray, settings: Settings) -> np.ndarray:
    """Unit length over all n-grams, so that a long text has no more say; the marks of form have a fixed one."""
    return np.where(found >= (1 << settings.hash_bits) - _FORM, settings.form, max(1, len(found)) ** -0.5)


def class_counts(docs: DataFrame, chosen: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Texts of the chosen (doc_id, label) by class, and by class and bucket; as many numbers as hash buckets, whatever the corpus.

    Null and empty texts count by their marks of form. Repeated rows count each.
    """
    size = 1 << settings.hash_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, size + 1), dtype=np.int64)
        for batch in batches:
            for text, y in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
                counts[y, features(text.as_py(), settings)] += 1
                counts[y, size] += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.reshape(-1)[at])], names=["at", "n"])

    # The chosen ids are at most count_rows for each class, so they go to the texts.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")
    found = rows.mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(2 * (size + 1), dtype=np.int64)
    counts[found["at"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    counts = counts.reshape(2, size + 1)
    return counts[:, size], counts[:, :size]


def log_ratios(counts: np.ndarray, smoothing: float) -> np.ndarray:
    """Log of each bucket's share of the smoothed counts of class 1 against class 0."""
    shares = (counts + smoothing) / (counts + smoothing).sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, costs: np.ndarray, epochs: int) -> np.ndarray:
    """Weights of the linear hinge-loss model by dual coordinate descent; the last one is the bias.

    Row i has `values[i]` at the distinct places `rows[i]` and 1 at the bias.
    """
    w, alpha = np.zeros(size + 1), np.zeros(len(y))
    norms = np.array([v @ v + 1 for v in values])
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(y)):
            gradient = y[i] * (w[rows[i]] @ values[i] + w[-1]) - 1
            fresh = min(max(alpha[i] - gradient / norms[i], 0.0), costs[i])
            change = fresh - alpha[i]
            if change:
                w[rows[i]] += change * y[i] * values[i]
                w[-1] += change * y[i]
                alpha[i] = fresh
                most = max(most, abs(change))
        if most < 1e-4:
            break
    return w


def fit(sample: list[tuple[str, int]], counts: np.ndarray, settings: Settings) -> Model:
    """A model of sampled rows and class counts; without both classes every score is the one label's, or 0.5."""
    size = 1 << settings.hash_bits
    y = np.array([label for _, label in sample], dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return Model(settings, np.zeros(size), 0.0, 0.0 if not len(y) else 40.0 * (2 * float(y[0]) - 1))
    ratios = log_ratios(counts, settings.smoothing)
    rows = [features(text, settings) for text, _ in sample]
    values = [ratios[r] * _scale(r, settings) for r in rows]
    share = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    folds = np.arange(len(y)) % 3
    margins = np.zeros(len(y))
    for fold in range(3):  # margins of rows that the weights have not seen
        train = np.flatnonzero(folds != fold) if len(y) >= 30 else np.arange(len(y))
        w = descend([rows[i] for i in train], [values[i] for i in train], 2 * y[train] - 1, size, settings.cost * share[train], settings.epochs)
        for i in np.flatnonzero(folds == fold):
            margins[i] = w[rows[i]] @ values[i]
    w = descend(rows, values, 2 * y - 1, size, settings.cost * share, settings.epochs)
    slope, offset = _calibrated(margins, y, settings.cut)
    return Model(settings, w[:-1] * ratios, slope, offset)


def _calibrated(margins: np.ndarray, y: np.ndarray, cut: float) -> tuple[float, float]:
    """Logistic slope of the margins; the cut with the fewest errors gets score `cut`."""
    order = np.unique(margins)
    cuts = np.concatenate(([order[0] - 1e-6], (order[1:] + order[:-1]) / 2))
    right = np.sort(margins[y == 1])
    wrong = np.sort(margins[y == 0])
    missed = np.searchsorted(right, cuts) + len(wrong) - np.searchsorted(wrong, cuts)
    best = cuts[missed == missed.min()]
    at = float(best[len(best) // 2])
    slope = 4.0 / (float(np.std(margins)) + 1e-9)
    return slope, float(np.log(cut / (1 - cut))) - slope * at


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings = Settings()) -> Model:
    """Fit on labels (doc_id, label column) of docs (doc_id, text); other columns have no part in it.

    An id labelled both 0 and 1 counts once for each. Labels without an id or document do not count.
    """
    named = labelled_ids(docs, labels, label)
    _, counts = class_counts(docs, sampled_ids(named, settings.count_rows), settings)
    return fit(labelled_sample(docs, sampled_ids(named, settings.sample_rows)), counts, settings)


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score (0 to 1, higher: label 1 likelier) of each whole text.

    Null and empty texts have no n-grams and get the score of a zero margin.
    Repeated rows score alike. A column named score is replaced; the others
    stay. No rows give none.
    """
    frame = docs.select(*[c for c in docs.columns if c != "score"])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one weight per hash bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            scores = [own.score(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema]
    return frame.mapInArrow(run, ", ".join([*fields, "score double"]))
