"""Importance resampling against plain Python counts, the exact k-th key, and odd labels."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plume.llm import importance as im

SF = "/root/testdata/sf0.01"


def test_weights_follow_the_two_models(spark):
    bits = 24  # so wide that no two features of the test meet
    docs = [(0, "good good words here"), (1, "bad stuff Bad"), (2, None), (3, ""), (4, "good words"), (None, "bad stuff"), (4, "good words")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, key int")
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0), (4, 1, None), (None, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    grams = [[Counter(w), Counter(zip(w, w[1:]))] for _, t in docs for w in [re.findall(r"\S+", (t or "").lower())]]
    target, raw = ([sum((g[k] for g in part), Counter()) for k in (0, 1)] for part in ([grams[0], grams[4], grams[6]], grams))
    def log_p(model, x):
        return math.log((model[x] + 0.5) / (model.total() + 0.5 * (1 << 23)))
    want = [sum(n * (log_p(target[k], x) - log_p(raw[k], x)) for k in (0, 1) for x, n in g[k].items()) for g in grams]
    rows = im.resample(df, labels, bits=bits).collect()
    assert sorted(round(r["log_weight"], 6) for r in rows) == sorted(round(w, 6) + 0.0 for w in want)
    n, share = len(docs), 3 / 4
    cut = sorted((r["key"] for r in rows), reverse=True)[math.ceil(share * n) - 1]
    assert all(r["kept"] == (r["key"] >= cut) for r in rows)


def test_kth_largest(spark):
    for values in ([1.0], [2.0] * 50, [float(i % 7) for i in range(500)], [math.exp(i / 50) for i in range(-900, 900)]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        for k in {1, len(values), len(values) // 2 or 1}:
            assert im.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]


def test_good_documents_stay(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = labels.where("pmod(xxhash64(doc_id), 10) >= 7")
    out = im.resample(docs, labels.join(held, "doc_id", "left_anti")).join(held, "doc_id")
    share = {r["quality"]: r["s"] for r in out.where("toxic = 0").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("s")).collect()}
    assert share[1] >= 0.9 and share[0] <= 0.2


@pytest.mark.parametrize("labels", [[], [(1, 0, 0)], [(1, None, 1)]])
def test_odd_labels_and_empty_tables(spark, labels):
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a b"), (2, None), (2, None)], "doc_id long, text string")
    rows = im.resample(docs, lab).collect()
    assert len(rows) == 3 and all(r["log_weight"] == 0 for r in rows)
    assert im.resample(docs.limit(0), lab).collect() == []
