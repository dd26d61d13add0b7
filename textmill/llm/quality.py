"""Quality classifier: support vectors on Naive Bayes features.

A text is the set of hashed n-grams of its words and of the shapes of its words (how long, upper
case, digits, closing sign, same word as before), as indicators. Each indicator is scaled by its
class log-count ratio, counted over all labelled rows; a linear hinge-loss model is fitted on
the scaled and length-normalised rows by dual coordinate descent, and a sigmoid turns margins into
scores. Only texts and labels are read.

The model is fitted on at most SAMPLE_ROWS labelled rows, the ones with the smallest hash of their
id; ratios cover all labelled rows. Its size is fixed by FEATURES, so it is sent to all tasks.

Defined results. A null text counts as empty; an empty text gets the score of the intercept. Of
several labels of one id the lowest counts; a null label or id counts as no label. With labels of
one class only, every score is that class's; without labels it is 0.5. Repeated rows get equal
scores. Further columns take no part and may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import broadcast_if_small, stage
from .sizes import handed_out
from .words import Slice, grams, mixed, slices, word_hashes, words

FEATURES = 1 << 18
SAMPLE_ROWS = 8_000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
SLICE_BYTES = 1 << 18  # of text that are worked on at once
KEEP_SCORE = 0.3


@dataclass
class Model:
    weights: np.ndarray  # by feature, the ratio included
    ratio: np.ndarray
    intercept: float
    slope: float
    offset: float
    constant: float | None = None

    def scores(self, features: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        if self.constant is not None:
            return np.full(n, self.constant)
        length = np.sqrt(np.bincount(text, self.ratio[features] ** 2, n) + 1.0)
        margin = (np.bincount(text, self.weights[features], n) + self.intercept) / length
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


_SIGN = np.zeros(256, np.uint64)
_SIGN[33:127] = np.arange(1, 95)
_SIGN[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 0
_UPPER, _DIGIT = np.zeros(256, np.int64), np.zeros(256, np.int64)
_UPPER[65:91], _DIGIT[48:58] = 1, 1


def _shapes(s: Slice, w, hashes: np.ndarray) -> np.ndarray:
    """A small code per word."""
    upper, digit = (np.concatenate(([0], np.cumsum(t[s.data]))) for t in (_UPPER, _DIGIT))
    upper, digit = upper[w.end] - upper[w.begin], digit[w.end] - digit[w.begin]
    code = np.searchsorted([2, 3, 5, 9, 17, 33], w.end - w.begin, "right").astype(np.uint64)
    same = np.zeros((2, len(hashes)), np.uint64)
    same[0, 1:], same[1, 2:] = hashes[1:] == hashes[:-1], hashes[2:] == hashes[:-2]
    for part, size in ((np.minimum(upper, 2), 3), (np.minimum(digit, 2), 3), (_SIGN[s.data[w.end - 1]], 95),
                       (_SIGN[s.data[w.begin]], 95), (same[0], 2), (same[1], 2)):
        code = code * np.uint64(size) + part.astype(np.uint64)
    return mixed(code)


def features(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (feature, text) pairs of a slice, by text."""
    w = words(s)
    hashes = word_hashes(s, w, lower=True)
    shapes = _shapes(s, w, hashes) if len(hashes) else hashes
    found = [grams(hashes, w.first, 1), grams(hashes, w.first, 2)] + [grams(shapes, w.first, n) for n in (1, 2, 3)]
    salt = mixed(np.arange(len(found), dtype=np.uint64))
    key = np.concatenate([t.astype(np.int64) * FEATURES + ((h ^ x) % np.uint64(FEATURES)).astype(np.int64)
                          for (h, t), x in zip(found, salt)])
    key = np.unique(key)
    return key % FEATURES, key // FEATURES


def _class_counts(batches):
    counts = np.zeros((2, FEATURES), np.int64)
    rows = np.zeros(2, np.int64)
    for batch in batches:
        label = batch.column("_label").to_numpy()
        rows += np.bincount(label, minlength=2)
        for s in slices(batch.column("text"), SLICE_BYTES):
            f, t = features(s)
            for y in (0, 1):
                counts[y] += np.bincount(f[label[s.first + t] == y], minlength=FEATURES)
    seen = np.flatnonzero(counts.sum(0))
    feature = np.append(seen, -1)  # -1 counts rows
    yield pa.RecordBatch.from_pydict({
        "feature": feature.astype(np.int32), "n0": np.append(counts[0, seen], rows[0]), "n1": np.append(counts[1, seen], rows[1])})


def _sample_features(batches):
    for batch in batches:
        label = batch.column("_label").to_pylist()
        for s in slices(batch.column("text"), SLICE_BYTES):
            f, t = features(s)
            cuts = np.searchsorted(t, np.arange(len(s) + 1))
            yield pa.RecordBatch.from_pydict({
                "label": pa.array(label[s.first : s.first + len(s)], pa.int32()),
                "features": pa.array([f[a:b].astype(np.int32) for a, b in zip(cuts, cuts[1:])], pa.list_(pa.int32()))})


class Rows:
    """Unit-length sparse rows: row i has its features, each with its ratio, and 1 for the intercept, over their length.

    Only the features are held, one after the other; values are made when a row is asked for.
    """

    def __init__(self, features: np.ndarray, cuts: np.ndarray, ratio: np.ndarray):
        self.features, self.cuts, self.value = features, cuts, np.append(ratio, 1.0)

    def __len__(self) -> int:
        return len(self.cuts) - 1

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        index = np.append(self.features[self.cuts[i] : self.cuts[i + 1]], len(self.value) - 1)
        value = self.value[index]
        return index, value / np.sqrt(value @ value)


def dual_descent(rows: Rows, y: np.ndarray, size: int) -> np.ndarray:
    """Hinge-loss weights (the last one is the intercept) of unit-length sparse rows (index, value)."""
    w, alpha = np.zeros(size), np.zeros(len(rows))
    turn = np.random.default_rng(1)
    for _ in range(EPOCHS):
        for i in turn.permutation(len(rows)):
            index, value = rows[i]
            gradient = y[i] * (w[index] @ value) - 1
            new = min(max(alpha[i] - gradient, 0.0), COST)  # rows have unit length
            if new != alpha[i]:
                w[index] += (new - alpha[i]) * y[i] * value
                alpha[i] = new
    return w


def sigmoid_of(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through margins and classes, by Newton's method."""
    x = np.stack([margin, np.ones_like(margin)])
    good, bad = (y > 0).sum(), (y < 0).sum()
    goal = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    p = np.array([1.0, 0.0])
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(p @ x, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))) @ x.T + 1e-6 * np.eye(2), x @ (goal - q) - 1e-6 * p)
        p = p + np.clip(step, -5, 5)
    return float(p[0]), float(p[1])


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on the labelled rows of ``docs`` for which ``train`` (of _id) holds.

    ``labels`` has doc_id and quality.
    """
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(
        F.min("quality").cast("int").alias("_label"))
    known = stage(known.where(F.col("_label").isin(0, 1) & (F.lit(True) if train is None else train)), "labels")
    texts = docs.select(F.col("doc_id").alias("_doc"), F.col("text").cast("string").alias("text"))
    rows = texts.join(broadcast_if_small(known), F.col("_doc") == F.col("_id")).select("_id", "text", "_label")
    counts = rows.select("text", "_label").mapInArrow(_class_counts, "feature int, n0 long, n1 long")
    counts = counts.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()  # at most FEATURES + 1
    total = counts[counts.feature < 0][["n0", "n1"]].sum().to_numpy()
    if total.min() == 0:
        constant = 0.5 if total.max() == 0 else float(total[1] > 0)
        return Model(np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 1.0, 0.0, constant)
    counts = counts[counts.feature >= 0]
    n = np.full((2, FEATURES), SMOOTHING)
    n[0, counts.feature], n[1, counts.feature] = counts.n0 + SMOOTHING, counts.n1 + SMOOTHING
    ratio = np.log(n[1] / n[1].sum()) - np.log(n[0] / n[0].sum())

    chosen = known.select("_id", F.xxhash64("_id").alias("h")).orderBy("h", "_id").limit(sample_rows).select("_id")
    sample = rows.join(F.broadcast(stage(chosen, "sample")), "_id").select("text", "_label")  # at most sample_rows ids
    sample = stage(sample.mapInArrow(_sample_features, "label int, features array<int>"), "features")

    def fit_rows(batches):
        labels, found, sizes = [], [], []
        for part in batches:
            labels.append(part.column("label").to_numpy())
            found.append(part.column("features").flatten().to_numpy().copy())
            sizes.append(part.column("features").value_lengths().to_numpy())
        rows = Rows(np.concatenate(found), np.concatenate(([0], np.cumsum(np.concatenate(sizes)))), ratio)
        y = 2.0 * np.concatenate(labels) - 1
        w = dual_descent(rows, y, FEATURES + 1)
        slope, offset = sigmoid_of(np.array([w[i] @ v for i, v in (rows[k] for k in range(len(rows)))]), y)
        yield pa.RecordBatch.from_pydict({"w": [w.tobytes()], "slope": [slope], "offset": [offset]})

    got = sample.coalesce(1).mapInArrow(fit_rows, "w binary, slope double, offset double").first()
    w = np.frombuffer(got["w"])
    return Model(w[:FEATURES] * ratio, ratio, float(w[FEATURES]), got["slope"], got["offset"])


def _scored(batch: pa.RecordBatch, model: Model) -> np.ndarray:
    out = np.empty(batch.num_rows)
    for s in slices(batch.column("text"), SLICE_BYTES):
        f, t = features(s)
        out[s.first : s.first + len(s)] = model.scores(f, t, len(s))
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    sent = handed_out(docs.sparkSession, model)  # 2 * FEATURES numbers

    def run(batches):
        model = sent()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_scored(batch, model))], ["doc_id", "score"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double")


def drop_rejected(docs: DataFrame, model: Model, least: float = KEEP_SCORE) -> DataFrame:
    """Rows of ``docs`` whose score is at least ``least``, with all their columns."""
    sent = handed_out(docs.sparkSession, model)

    def run(batches):
        model = sent()
        for batch in batches:
            yield batch.filter(pa.array(_scored(batch, model) >= least))

    return docs.mapInArrow(run, docs.schema)
