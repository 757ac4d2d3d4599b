"""Graded quality by cumulative-link regression on hashed text.

A document is a set of hashed features: its words, the beginnings of its words, and a few ranges of shape (length,
repetition, capitals, signs, digits, word length). One weight vector is shared by all grades: its sum z over the features is
compared with ordered thresholds, ``P(grade <= k) = sigmoid(threshold[k] - z)``. That gives the expected grade and the
probability of the highest grades, by which documents are selected.

The model is fitted on a bounded sample of the labelled documents: at most ``SAMPLE`` of each grade, those whose ids
have the smallest hashes, the same ones on every run. All documents are scored, over their whole texts, in one pass without
a shuffle; the model has a fixed size.

Edge cases: a text that is null or has no words gets the lowest grade; labels that are null or name no document are
ignored; several labels of one document count as the lowest; grades without any document have no threshold; without
labels every document with words gets the highest grade; an empty table gives an empty result; further columns of any
name are ignored by ``graded`` and pass ``select_good`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.llm.wordhash import Words, in_chunks, mix

BITS = 18
# Labelled documents per grade that the model is fitted on.
SAMPLE = 6000
EPOCHS = 20
BATCH = 128
RATE = 0.3
SHRINK = 1e-5
START = 1e-4
# A word counts as a sign of a lower grade if the log of its ratio to the highest one, and the difference in standard
# errors, are so high.
LIFT, ERRORS = 1.5, 8.0
# Documents at least this likely to have the highest grade are good.
TAIL = 0.5
# Lengths in bytes of the word beginnings that are features, and the upper ends of the ranges of shape.
BEGINNINGS = (4, 5)
# Numbers below SHAPES are features of shape, those from PAIRED on of length and repetition together.
SHAPES, PAIRED = 512, 128
RANGES = (0.02, 0.05, 0.1, 0.2, 0.3, 0.45, 0.6, 0.8)

SCORES = (
    T.StructType()
    .add("doc_id", T.LongType())
    .add("expected_grade", T.DoubleType())
    .add("tail_probability", T.DoubleType())
    .add("kept", T.BooleanType())
)


def _table(low: int, high: int) -> np.ndarray:
    out = np.zeros(256, bool)
    out[low : high + 1] = True
    return out


CAPITAL, DIGIT = _table(65, 90), _table(48, 57)
SIGN = ~(_table(65, 90) | _table(97, 122) | _table(48, 57) | _table(128, 255) | _table(9, 13) | _table(32, 32))


def features(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted feature numbers of each text; none for a text without words."""
    words = Words(texts)
    hashed = [words.hashes, *(words.beginnings(n) for n in BEGINNINGS)]
    mask = np.uint64((1 << BITS) - 1)
    hashed = [(mix(h + np.uint64(n)) & mask).astype(np.uint32) | np.uint32(SHAPES) for n, h in enumerate(hashed)]
    out = []
    for text, start, end in zip(texts, words.starts[:-1].tolist(), words.starts[1:].tolist(), strict=True):
        if start == end:
            out.append(np.zeros(0, np.uint32))
            continue
        count, data = end - start, np.frombuffer(text, np.uint8)
        distinct = len(np.unique(words.hashes[start:end]))
        shares = (
            min(1.0, count.bit_length() / 16), distinct / count, CAPITAL[data].mean(), SIGN[data].mean(), DIGIT[data].mean(),
            min(1.0, len(data) / count / 20), abs(text.count(b"\n") / count),
        )
        ranges = np.searchsorted(RANGES, shares)
        # repetition means something else in longer texts
        shape = np.append(np.arange(len(ranges)) * 16 + ranges, PAIRED + ranges[0] * 16 + ranges[1]).astype(np.uint32)
        out.append(np.unique(np.concatenate([*(h[start:end] for h in hashed), shape])))
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Weights of features, and thresholds between the ordered ``grades`` that occurred."""

    grades: list[int]
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))

    def sums(self, rows: list[np.ndarray]) -> np.ndarray:
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = self.weights[np.concatenate(rows)] if len(rows) else np.zeros(0)
        total = np.concatenate((np.zeros(1), np.cumsum(flat, dtype=np.float64)))
        ends = np.cumsum(sizes)
        return total[ends] - total[ends - sizes]

    def chances(self, z: np.ndarray) -> np.ndarray:
        """One row per sum, one column per grade."""
        below = sigmoid(self.thresholds[None, :] - z[:, None])
        edges = np.concatenate((np.zeros((len(z), 1)), below, np.ones((len(z), 1))), 1)
        return np.diff(edges, axis=1)


def signs(rows: list[np.ndarray], level: np.ndarray, levels: int) -> np.ndarray:
    """Which features the model may use: those of shape, and words that are frequent in a lower grade."""
    use = np.zeros(1 << BITS, bool)
    use[:SHAPES] = True
    counts = [
        np.bincount(np.concatenate([rows[n] for n in np.flatnonzero(level == k)]), minlength=1 << BITS) + 0.5
        for k in range(levels)
    ]
    sizes = np.bincount(level, minlength=levels) + 1
    for k in range(levels - 1):
        lift = np.log(counts[k] / sizes[k]) - np.log(counts[-1] / sizes[-1])
        both = (counts[k] + counts[-1]) / (sizes[k] + sizes[-1])
        error = np.sqrt(both * (1 - np.minimum(both, 0.999)) * (1 / sizes[k] + 1 / sizes[-1]))
        use |= (lift >= LIFT) & (counts[k] / sizes[k] - counts[-1] / sizes[-1] >= ERRORS * error)
    return use


def fit(rows: list[np.ndarray], grades: list[int], epochs: int = EPOCHS) -> Model:
    """Adagrad on the likelihood of the grades, each grade with the same total weight, in batches of a fixed random order.

    A long text has many words, so words without a bearing on the grade would add up to noise: only signs of a lower
    grade get weights.
    """
    model = Model(sorted(set(grades)))
    levels = len(model.grades)
    if levels < 2:
        return model
    level = np.searchsorted(model.grades, grades)
    use = signs(rows, level, levels)
    rows = [r[use[r]] for r in rows]
    share = np.bincount(level, minlength=levels)
    importance = share.max() / share
    shares = np.arange(1, levels) / levels
    model.thresholds = np.log(shares / (1 - shares))
    # ordered thresholds: the first one and the logarithms of the gaps
    bounds = np.concatenate((model.thresholds[:1], np.log(np.maximum(np.diff(model.thresholds), 1e-3))))
    squares, bound_squares = np.full(1 << BITS, START), np.full(levels - 1, START)
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            own = [rows[n] for n in part]
            sizes = np.fromiter(map(len, own), np.int64, len(own))
            z, k = model.sums(own), level[part]
            edges = np.concatenate(([-40.0], model.thresholds, [40.0]))
            upper, lower = sigmoid(edges[k + 1] - z), sigmoid(edges[k] - z)
            chance = np.maximum(upper - lower, 1e-12)
            up, low = upper * (1 - upper) / chance, lower * (1 - lower) / chance
            # derivatives of -log(chance)
            up, low = up * importance[k], low * importance[k]
            slope = up - low
            flat = np.concatenate(own)
            used, of = np.unique(flat, return_inverse=True)
            step = np.bincount(of, np.repeat(slope / len(part), sizes)) + SHRINK * model.weights[used]
            squares[used] += step * step
            model.weights[used] -= RATE * step / np.sqrt(squares[used])
            by_edge = np.bincount(k + 1, -up, levels + 1) + np.bincount(k, low, levels + 1)
            inner = by_edge[1:levels] / len(part)
            gaps = np.concatenate(([1.0], np.exp(bounds[1:])))
            step = np.cumsum(inner[::-1])[::-1] * gaps
            bound_squares += step * step
            bounds -= RATE * step / np.sqrt(bound_squares)
            model.thresholds = np.cumsum(np.concatenate((bounds[:1], np.exp(bounds[1:]))))
    return model


def hashed(docs: DataFrame) -> DataFrame:
    """``(grade, features)`` of rows ``(grade, text)`` with words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for chunk in in_chunks(batch.column(1).cast(pa.binary()).to_pylist()):
                found = pa.array([f.tobytes() or None for f in features(chunk)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(chunk)), found], names=["grade", "features"])
                at += len(chunk)

    return docs.mapInArrow(rows, "grade int, features binary").where("features is not null")


def fit_on(docs: DataFrame, labels: DataFrame, grade: Column, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """A model fitted on up to ``sample`` labelled documents of each grade."""
    graded = labels.select(labels[doc_id].alias("_id"), grade.cast("int").alias("_grade")).dropna()
    graded = graded.groupBy("_id").agg(F.min("_grade").alias("_grade"))
    chosen = None
    for value in sorted(r[0] for r in graded.select("_grade").distinct().collect()):  # the few grades of the scale
        part = graded.where(F.col("_grade") == value).orderBy(F.xxhash64("_id"), "_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return Model([])
    # bounded: the sample's ids
    rows = docs.select(docs[doc_id].alias("_id"), docs[text].alias("_text")).join(F.broadcast(chosen), "_id")
    found = hashed(rows.select("_grade", "_text")).collect()
    found.sort(key=lambda r: (r.grade, bytes(r.features)))
    return fit([np.frombuffer(r.features, np.uint32) for r in found], [r.grade for r in found])


def graded(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", tail: float = TAIL) -> DataFrame:
    """``(doc_id, expected_grade, tail_probability, kept)`` of each row; the tail is the highest grade."""
    score = scorer(model, tail)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for chunk in in_chunks(batch.column(1).cast(pa.binary()).to_pylist()):
                ids = batch.column(0).slice(at, len(chunk))
                at += len(chunk)
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, score(chunk))], names=SCORES.names)

    return docs.select(docs[doc_id].cast("long"), docs[text]).mapInArrow(rows, SCORES)


def scorer(model: Model, tail: float):
    def score(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = features(texts)
        grades = np.array(model.grades or [1], float)
        chances = model.chances(model.sums(rows))
        empty = np.array([not len(r) for r in rows], bool)
        expected = np.where(empty, grades[0], chances @ grades)
        top = np.where(empty & (len(grades) > 1), 0.0, chances[:, -1])
        return expected, top, (top >= tail) & ~empty

    return score


def select_good(docs: DataFrame, model: Model, text: str = "text", tail: float = TAIL) -> DataFrame:
    """The rows whose text is likely to have the highest grade, with all their columns."""
    score = scorer(model, tail)

    @F.arrow_udf(T.BooleanType())
    def good(texts: pa.Array) -> pa.Array:
        parts = [score(chunk)[2] for chunk in in_chunks(texts.cast(pa.binary()).to_pylist())]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, bool))

    return docs.where(good(F.col(text)))
