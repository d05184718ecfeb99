"""Quality rules against a plain Python count, the model's held-out accuracy, and odd inputs."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plume.llm import quality_rules as q

SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    times = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    again = set()
    for i in range(len(words) - 4):
        if times[tuple(words[i:i + 5])] > 1:
            again.update(range(i, i + 5))
    failed = len(words) < 10 or 100 * len(again) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(again), failed)


ODD = [None, "", " \n\t ", "one", "a b c d e f g h i j", "x " * 40, "Ünï 漢字 & <b> | #\n\nx\nx\n x\n" * 3,
       "a b c d e a b c d e " + "w1 w2 w3 w4 w5 w6 w7 w8 w9 " * 1, "l\r\nl\r\nl\x0bl\x85l l",
       " ".join(f"w{i}" for i in range(60000))]


def test_base_statistics_equal_brute_force(spark):
    own = spark.createDataFrame([(i, t, "extra", 7) for i, t in enumerate(ODD)],
                                "doc_id long, text string, n_words string, quality int")
    stored = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for docs in (own, own.unionByName(own), stored):
        rows = {}
        for r in q.judge(docs, labels).collect():
            rows.setdefault(r["doc_id"], []).append(
                (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]))
            assert r["probability"] is None and r["kept"] == (not r["base_failed"])
        want = {}
        for r in docs.collect():
            want.setdefault(r["doc_id"], []).append(brute(r["text"]))
        assert rows == want


def test_classifier_finds_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    train = labels.where("pmod(xxhash64(doc_id), 10) < 7")
    rest = labels.join(train.select("doc_id"), "doc_id", "left_anti")
    out = q.judge(docs, train).join(rest, "doc_id").where("not base_failed")
    right, n = out.agg(F.sum((F.col("kept") == (F.col("quality") == 1)).cast("int")), F.count("*")).first()
    assert n > 30 and right >= 0.95 * n


@pytest.mark.parametrize("labels", [[(1, None), (None, 1)], [(1, 1)], [(1, 1), (1, 0), (2, 0), (2, 0), (99, 1), (3, 5)]])
def test_odd_labels(spark, labels):
    docs = spark.createDataFrame([(1, "good words " * 9), (2, "# * #"), (None, None), (1, "good")], "doc_id long, text string")
    out = q.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(out) == 4


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert q.judge(docs, spark.createDataFrame([], "doc_id long, quality int")).collect() == []


def test_keep_good_keeps_columns_and_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("text", "doc_id", "doc_id AS `kept`", "source")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = q.train(docs, labels)
    want = q.judge(docs, labels, model).where("kept").select("doc_id")
    got = q.keep_good(docs, labels, model)
    assert got.columns == docs.columns
    assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(r[0] for r in want.collect())
