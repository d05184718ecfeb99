"""Word pairs by log-likelihood ratio (K1)."""

import math
import random
from collections import Counter

from plume.operators import text as TX


def test_pairs_that_belong_together_come_first(spark):
    rng = random.Random(1)
    rows = []
    for k in range(400):
        words = [f"w{rng.randrange(40)}" for _ in range(30)]
        if k % 3 == 0:
            words[10:10] = ["neural", "network"]
        rows.append((k, " ".join(words) + ". the network of 2024. visit http://neural.network now"))
    out = TX.collocations(spark.createDataFrame(rows, "doc_id long, text string"), top_n=5).collect()
    assert out[0]["keyword"] == "neural network" and out[0]["mentions"] == 134
    assert out[0]["score"] > 20 * max(r["score"] for r in out[1:])  # raw counts would put chance pairs near it
    # The score by hand.
    pairs = Counter()
    for _, t in rows:
        words = t.split(".")[0].split()
        pairs.update(zip(words, words[1:]))
    n, total = pairs["neural", "network"], sum(pairs.values())
    na, nb = sum(v for (a, _), v in pairs.items() if a == "neural"), sum(v for (_, b), v in pairs.items() if b == "network")
    cells = [(n, na, nb), (na - n, na, total - nb), (nb - n, total - na, nb), (total - na - nb + n, total - na, total - nb)]
    want = 2 * sum(k * math.log(k * total / (r * c)) for k, r, c in cells if k)
    assert abs(out[0]["score"] - want) < 0.01 * want


def test_nothing_to_pair(spark):
    for rows in ([], [(1, None), (2, ""), (3, "one"), (4, "the of the of. 12 13")]):
        assert TX.collocations(spark.createDataFrame(rows, "doc_id long, text string"), min_count=1).collect() == []


def test_phrases_of_a_sql_user_are_those_that_are_counted(spark):
    from pyspark.sql import functions as F

    from plume.functions import sql

    sql.register(spark)
    rows = [(1, "Neural network training is fun. Neural network! see http://x.y/z big data pipelines\nthe end of 2024 budgets"), (2, None), (3, ""), (4, "one")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    own = df.select("doc_id", F.expr("plume_extract_phrases(text)").alias("p"))
    counted = {r["keyword"]: r["mentions"] for r in TX.keyword_topn(df, top_n=100, min_phrases=0).collect() if " " in r["keyword"]}
    found = Counter(g for r in own.collect() for g in (r["p"] or []))
    assert found == counted and found["big data pipelines"] == 1 and len(found) > 3
