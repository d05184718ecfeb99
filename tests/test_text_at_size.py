"""Texts are split and judged once, whatever a query makes of them."""

import re

from plume.functions import sql as SQLF
from plume.operators import text as TX

TEXTS = [
    (1, "Deep neural networks learn. Deep neural networks 2024 data, deep neural networks!"), (2, None), (3, ""), (4, " . ; "),
    (5, "the quick brown foxes\nquick brown foxes of http://x.y/z quick brown foxes"), (6, "aikido lessons 42 ai"), (7, "one")]


def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_keywords_judge_every_word_once(spark):
    df = TX.keyword_topn(docs(spark), "text", 20)
    assert plan(df).count("arrays_zip") == 1 and plan(df).count("concat_ws") == 0
    got = {r["keyword"]: r["mentions"] for r in df.collect()}
    assert got["deep neural networks"] == 3 and got["quick brown foxes"] == 3 and got["neural networks"] == 3
    assert not any(re.search("2024|http| of |^the ", k) for k in got)


def test_phrases_of_the_operator_and_of_sql_are_the_same(spark):
    SQLF.register(spark)
    docs(spark).createOrReplaceTempView("phrase_texts")
    rows = spark.sql("SELECT doc_id, plume_extract_phrases(text) AS p FROM phrase_texts").collect()
    by_sql = {}
    for r in rows:
        for g in r["p"] or []:
            by_sql[g] = by_sql.get(g, 0) + 1
    whole = TX._candidates(TX._segment_tokens(docs(spark), "text"), 2, 4, 8, *TX._lists(None, None, None))
    assert {r["keyword"]: r["n"] for r in whole.where("kind = 0").groupBy("keyword").agg({"kind": "count"}).toDF("keyword", "n").collect()} == by_sql
    assert "slice(" not in SQLF.phrases_sql() and len(by_sql) > 3


def test_related_texts_are_split_and_signed_once(spark):
    df = TX.related_groups(docs(spark))
    assert "md5" not in plan(df)  # the buckets are stored
    signed = docs(spark).select(TX.minhash_signature("text").alias("s"))
    assert plan(signed).count("split(") == 1
    assert {r["doc_id"] for r in df.where("related").collect()} <= {1, 5, 6, 7}
    assert {r["doc_id"]: r["group_id"] for r in df.where("doc_id IN (2, 3, 4)").collect()} == {2: 2, 3: 3, 4: 4}
