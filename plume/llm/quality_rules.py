"""Quality rules: fixed text statistics, and a hashed n-gram logistic
regression trained on labelled quality rows, calibrated, and scored in Arrow
batches against a threshold that is fixed when the model is.

Training takes a bounded sample of labelled rows (:data:`SAMPLE`, chosen by a
hash of doc_id, each class up to half); scoring reads every whole text. The
calibration rows are weighed by the class counts of all labels, so that a
probability means the same at every table size, and the cut comes from
held-out rows.

Defined results: null and empty texts have no words and fail the base rule;
repeated rows are judged alike, row by row; rows without a label are only
scored; labels other than 0 and 1, or null, are not used; if either class has
no usable row there is no model and the base rules alone decide
(``probability`` null). Extra columns are ignored. A null ``doc_id`` is
carried through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plume.llm import textbatch as tb
from plume.llm.common import map_batches, map_whole, text_columns

#: Labelled rows used to fit the classifier, at most; half for each class.
SAMPLE = 3000
#: Feature buckets for words (one and two in a row) and for characters (three bytes in a row).
WORD_BITS, CHAR_BITS = 15, 15
#: A row is kept if its calibrated probability of good quality reaches the cut: the highest one, MOST at most, below
#: which no more than this share of the held-out good rows falls.
GOOD_LOST = 0.005
MOST = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20

_SYMBOLS = tb.table(lambda b: chr(b) in "#*$%&|<>")
_CHAR = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)

BASE = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean")
SCHEMA = f"doc_id long, {BASE}, kept boolean, probability double"


def base_statistics(texts: tb.Texts, w: tb.Words) -> dict[str, np.ndarray]:
    n = len(texts)
    bounds = texts.bounds
    solid = tb.NOT_BLANK[texts.data]
    heads = solid & ((texts.data & 0xC0) != 0x80)  # first byte of each code point
    lines = tb.words(texts, tb.NOT_NEWLINE)
    filled = np.concatenate([[0], np.cumsum(solid)])
    worded = filled[lines.end] > filled[lines.start]
    text = lines.text_of()[worded]
    _, distinct = tb.counts(lines.hash[worded], text, n)
    window, at = tb.windows(w, 5)
    times, _ = tb.counts(window, np.searchsorted(w.first, at, "right") - 1, n)
    step = np.zeros(len(w.hash) + 1, np.int64)
    again = at[times > 1]
    np.add.at(step, again, 1)
    np.add.at(step, again + 5, -1)
    covered = np.cumsum(step)[:-1] > 0
    out = {
        "n_words": w.per_text,
        "word_chars": tb.sum_by_text(heads, bounds),
        "n_symbols": tb.sum_by_text(_SYMBOLS[texts.data], bounds),
        "n_dup_lines": np.bincount(text, minlength=n) - distinct,
        "n_repeat_words": tb.sum_by_text(covered, w.first),
    }
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (
        100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
    return out


def features(texts: tb.Texts, w: tb.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per family (word, word pair, character trigram): feature ids and the bounds of each text in them."""
    shift = tb.U64(64 - WORD_BITS)
    pair, at = tb.windows(w, 2)
    data = texts.data
    n = max(len(data) - 2, 0)
    chars = data[:n].astype(np.uint32) * _CHAR[0]
    chars += data[1:n + 1].astype(np.uint32) * _CHAR[1]
    chars += data[2:n + 2].astype(np.uint32) * _CHAR[2]
    chars ^= chars >> np.uint32(15)
    chars *= np.uint32(0x2C1B3C6D)
    ends = np.maximum(texts.bounds[1:] - 2, texts.bounds[:-1])
    starts = np.minimum(texts.bounds[:-1], n)
    word = (w.hash >> shift).astype(np.int64)
    return [
        (word, np.stack([w.first[:-1], w.first[1:]])),
        ((pair >> shift).astype(np.int64) + (1 << WORD_BITS),
         np.stack([np.searchsorted(at, w.first[:-1]), np.searchsorted(at, w.first[1:])])),
        ((chars >> np.uint32(32 - CHAR_BITS)).astype(np.int64) + (2 << WORD_BITS),
         np.stack([starts, np.minimum(ends, n).clip(starts)])),
    ]


N_FEATURES = (2 << WORD_BITS) + (1 << CHAR_BITS)


@dataclass(frozen=True)
class Model:
    """Score: for each family the mean weight over its occurrences; then a fitted logistic curve."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    cut: float

    def probability(self, texts: tb.Texts, w: tb.Words) -> np.ndarray:
        score = np.full(len(texts), self.bias)
        for ids, (lo, hi) in features(texts, w):
            total = np.concatenate([[0.0], np.cumsum(self.weights[ids])])
            score += (total[hi] - total[lo]) / np.maximum(hi - lo, 1)
        return _logistic(self.slope * score + self.offset)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _marked(labels: DataFrame) -> DataFrame:
    """One label for each labelled document."""
    return text_columns(labels, "doc_id", "quality").where(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("quality").cast("int").alias("quality"))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Up to SAMPLE / 2 labelled rows of each class, by a hash of doc_id."""
    marked = _marked(labels)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = None
    for value in (0, 1):
        part = marked.where(F.col("quality") == value).orderBy(*order).limit(SAMPLE // 2)
        chosen = part if chosen is None else chosen.unionAll(part)
    return text_columns(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")  # SAMPLE rows at most


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct feature ids and values of each sampled row; at most N_FEATURES entries a row."""
    for part in tb.slices(batches):
        texts = tb.as_texts(part.column("text"))
        w = tb.words(texts)
        families = features(texts, w)
        ids, values = [], []
        for i in range(len(texts)):
            row = np.zeros(0, np.int64)
            value = np.zeros(0, np.float32)
            for f, (lo, hi) in families:
                own, count = np.unique(f[lo[i]:hi[i]], return_counts=True)
                row = np.concatenate([row, own])
                value = np.concatenate([value, (count / max(hi[i] - lo[i], 1)).astype(np.float32)])
            ids.append(row.astype(np.int32).tobytes())
            values.append(value.astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("quality"), pa.array(ids, pa.binary()),
             pa.array(values, pa.binary())], names=["doc_id", "quality", "ids", "values"])


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on the bounded sample; four rows in five for the weights, the rest for the calibration."""
    rows = _sample(docs, labels).mapInArrow(
        _vectors, "doc_id long, quality int, ids binary, values binary").toPandas()
    rows = rows.sort_values(["doc_id", "ids"], kind="stable").reset_index(drop=True)
    y = rows["quality"].to_numpy(np.float64)
    if not len(y) or y.min() == y.max():
        return None
    ids = [np.frombuffer(x, np.int32) for x in rows["ids"]]
    values = [np.frombuffer(x, np.float32) for x in rows["values"]]
    held = np.arange(len(y)) % 5 == 4
    if min(len(set(y[held])), len(set(y[~held]))) < 2:
        held = np.zeros(len(y), bool)
    fit = np.flatnonzero(~held)
    weights, bias = _descend([ids[i] for i in fit], [values[i] for i in fit], y[fit])
    score = np.array([float(weights[i] @ v) + bias for i, v in zip(ids, values, strict=True)])
    at = held if held.any() else ~held
    # The sample holds each class up to a bound; the calibration counts the classes as the labels do, whatever the table's size.
    count = {r["quality"]: r["count"] for r in _marked(labels).groupBy("quality").count().collect()}
    own = np.where(y[at] > 0, count[1] / y[at].sum(), count[0] / (1 - y[at]).sum())
    slope, offset = _calibrate(score[at], y[at], own * len(own) / own.sum())
    good = np.sort(_logistic(slope * score[at] + offset)[y[at] > 0])
    return Model(weights, bias, slope, offset, min(MOST, float(good[int(GOOD_LOST * len(good))])))


def _descend(ids: list[np.ndarray], values: list[np.ndarray], y: np.ndarray,
             rounds: int = 80, rate: float = 0.5, decay: float = 1e-6) -> tuple[np.ndarray, float]:
    """Full-batch Adam; both classes weigh the same."""
    flat, value = np.concatenate(ids).astype(np.int64), np.concatenate(values).astype(np.float64)
    row = np.repeat(np.arange(len(y)), [len(x) for x in ids])
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w, b = np.zeros(N_FEATURES), 0.0
    m, v = np.zeros(N_FEATURES + 1), np.zeros(N_FEATURES + 1)
    for t in range(1, rounds + 1):
        score = np.bincount(row, value * w[flat], len(y)) + b
        error = (_logistic(score) - y) * share
        g = np.append(np.bincount(flat, value * error[row], N_FEATURES) + decay * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def _calibrate(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic curve through held-out scores of given weights, with smoothed targets (Newton steps)."""
    good = (weight * y).sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (weight.sum() - good + 2))
    scale = max(float(np.abs(score).max()), 1e-9)
    x = np.stack([score / scale, np.ones_like(score)], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = _logistic(x @ beta)
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (weight * (p - target)) + 1e-6 * beta)
        beta = beta - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def judge(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document with the base statistics, the probability and the verdict."""
    shared = _shared(docs, labels, model)
    return map_batches(text_columns(docs, "doc_id", "text"),
                       lambda part: _verdicts(part, shared.value) | {"doc_id": part.column("doc_id")}, SCHEMA)


def keep_good(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents that pass, with all their columns; no shuffle."""
    shared = _shared(docs, labels, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tb.slices(batches):
            yield part.filter(pa.array(_verdicts(part, shared.value)["kept"]))

    return map_whole(docs, run)


def _shared(docs: DataFrame, labels: DataFrame, model: Model | None):
    """The model as a broadcast: N_FEATURES weights, a fixed size."""
    return docs.sparkSession.sparkContext.broadcast(model or train(docs, labels))


def _verdicts(part: pa.RecordBatch, model: Model | None) -> dict:
    texts = tb.as_texts(part.column("text"))
    w = tb.words(texts)
    out = base_statistics(texts, w)
    if model is None:
        return out | {"probability": pa.nulls(len(texts), pa.float64()), "kept": ~out["base_failed"]}
    p = model.probability(texts, w)
    return out | {"probability": p, "kept": ~out["base_failed"] & (p >= model.cut)}
