"""Importance resampling: documents are drawn in proportion to the ratio of
two hashed n-gram models, one of target text and one of all raw text, by
Gumbel top-k.

The raw model counts every word and word pair of every document. The target
model counts a bounded sample (:data:`SAMPLE` rows, by a hash of doc_id) of
the rows labelled good and not toxic. A document's log weight is the sum of
its features' log ratios. It is drawn if its log weight at the common length
(:data:`LENGTH` times the mean of its features' log ratios) plus Gumbel noise
(from a hash of doc_id and the seed) is among the k largest, where k is a share
of all documents, by default the share of good rows among the labelled ones.
At its own length a text's weight would say how long it is: the raw model has
seen every text, the target model a sample, so each feature costs a little.

Defined results: null and empty texts have weight 0 (ratio 1); without target
rows every weight is 0 and the noise alone draws; without labels the share is
1; rows with the same doc_id have the same noise, null ids share one; rows
that tie with the k-th are all drawn. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plume.llm import textbatch as tb
from plume.llm.common import map_batches, stored, text_columns

#: Labelled target rows used to fit the target model, at most.
SAMPLE = 20_000
BITS = 16
SMOOTHING = 0.5
SEED = 7
#: Features that a text counts for when it is drawn.
LENGTH = 100
#: Histogram bins of each round of the search for the k-th largest key.
BINS = 4096


def _features(texts: tb.Texts, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of each word and word pair; the two halves of the buckets."""
    w = tb.words(texts, fold=True)
    pair, at = tb.windows(w, 2)
    shift = tb.U64(65 - bits)
    bucket = np.concatenate([(w.hash >> shift).astype(np.int64),
                             (pair >> shift).astype(np.int64) + (1 << (bits - 1))])
    return bucket, np.concatenate([w.text_of(), np.searchsorted(w.first, at, "right") - 1])


def bucket_counts(docs: DataFrame, bits: int) -> np.ndarray:
    """Features by bucket over all documents: one array of 2**bits counts a slice, summed by Spark."""
    def count(part: pa.RecordBatch) -> dict:
        own = np.bincount(_features(tb.as_texts(part.column("text")), bits)[0], minlength=1 << bits)
        at = np.flatnonzero(own)
        return {"bucket": at, "n": own[at]}

    rows = map_batches(text_columns(docs, "text"), count, "bucket int, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).toPandas()  # 2**bits rows at most
    out = np.zeros(1 << bits)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def target_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    chosen = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    return text_columns(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")  # SAMPLE ids at most


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    if not target.sum():
        return np.zeros(len(raw))
    # Half of the buckets for words, half for pairs: a model for each.
    out = []
    for t, r in zip(np.split(target, 2), np.split(raw, 2), strict=True):
        smooth = SMOOTHING * len(t)
        out.append(np.log((t + SMOOTHING) / (t.sum() + smooth)) - np.log((r + SMOOTHING) / (r.sum() + smooth)))
    return np.concatenate(out)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Gumbel noise from a hash of the id: the same in every run and on every executor."""
    bits = F.shiftrightunsigned(F.xxhash64(F.coalesce(doc_id, F.lit(-1)), F.lit(seed)), 12).cast("double")
    return -F.log(-F.log((bits + 0.5) / float(1 << 52)))


def kth_largest(keys: DataFrame, column: str, k: int) -> float:
    """Exact k-th largest value: rounds of BINS counts, then of the values of one narrow bin."""
    values = keys.select(F.col(column).cast("double").alias("v"))
    lo, hi = values.agg(F.min("v"), F.max("v")).first()
    above = 0
    while lo < hi:
        inside = values.where(F.col("v").between(lo, hi))
        width = (hi - lo) / BINS
        counted = inside.groupBy(F.least(F.floor((F.col("v") - lo) / width), F.lit(BINS - 1)).alias("bin")).agg(
            F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy(F.desc("bin")).collect()
        for row in counted:  # BINS rows at most
            if above + row["n"] >= k:
                break
            above += row["n"]
        lo, hi = row["lo"], row["hi"]
    return lo


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = SEED,
             bits: int | None = None) -> DataFrame:
    """One row per document: log weight, key, drawn or not."""
    bits = bits or BITS  # goes to the executors as an argument
    ratio = log_ratio(bucket_counts(target_rows(docs, labels), bits), bucket_counts(docs, bits))
    shared = docs.sparkSession.sparkContext.broadcast(ratio)  # 2**bits values

    def score(part: pa.RecordBatch) -> dict:
        bucket, text = _features(tb.as_texts(part.column("text")), bits)
        n = part.num_rows
        return {"doc_id": part.column("doc_id"), "n_features": np.bincount(text, minlength=n),
                "log_weight": np.bincount(text, shared.value[bucket], n)}

    keys = stored(map_batches(text_columns(docs, "doc_id", "text"), score,
                              "doc_id long, n_features long, log_weight double").withColumn(
        "key", LENGTH * F.col("log_weight") / F.greatest("n_features", F.lit(1)) + gumbel(F.col("doc_id"), seed)), "importance")
    n = keys.count()
    if not n:
        return keys.withColumn("kept", F.lit(True))
    if share is None:
        share = labels.agg(F.avg(F.expr("cast(quality = 1 as double)"))).first()[0]
        share = 1.0 if share is None else share
    k = min(n, math.ceil(share * n))
    return keys.withColumn("kept", F.col("key") >= kth_largest(keys, "key", k) if k else F.lit(False))
