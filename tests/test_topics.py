"""Topic model by joins (K5) and vocabularies as tables (K2)."""

import math
import pathlib
import random
import re
import time

import pytest

from plume.operators import text as TX
from plume.operators import topics as T


def mixed(n=120, seed=1):
    """Documents of two planted topics, each with words of its own and some shared ones."""
    rng = random.Random(seed)
    kinds = [[f"apple{i}" for i in range(30)], [f"engine{i}" for i in range(30)]]
    shared = [f"common{i}" for i in range(5)]
    return [(i, " ".join(rng.choices(kinds[i % 2], k=40) + rng.choices(shared, k=6))) for i in range(n)]


def test_planted_topics_are_found_and_the_posterior_never_falls(spark):
    model = T.fit_topics(spark.createDataFrame(mixed(), "doc_id long, text string"), k=2, rounds=25)
    gains = [b - a for a, b in zip(model.posterior, model.posterior[1:])]
    assert len(model.posterior) == 25 and min(gains) > -1e-6 and model.posterior[-1] > model.posterior[0] + 1000
    top = {}
    for r in T.top_terms(model, 8).collect():
        top.setdefault(r["topic"], set()).add(re.sub(r"\d", "", r["term"]))
    assert sorted(map(sorted, (t - {"common"} for t in top.values()))) == [["apple"], ["engine"]]
    share = {r["doc_id"]: r["t0"] for r in model.documents.collect()}
    sides = [[v > 0.5 for i, v in share.items() if i % 2 == k] for k in (0, 1)]
    assert all(sides[0]) != all(sides[1]) and len(set(sides[0])) == len(set(sides[1])) == 1


def plain_em(docs, k, rounds):
    """The same model over dictionaries."""
    import hashlib
    from collections import Counter, defaultdict

    from plume.functions import lexicon as L

    stop = set(L.phrase_stop_words())
    counts = {i: Counter(w for w in re.split(r"[^\w]+", t.lower()) if len(w) >= 3 and w not in stop) for i, t in docs}
    words = {w for c in counts.values() for w in c}
    phi = {w: [(int(hashlib.md5(f"{i}:{w}".encode()).hexdigest()[:7], 16) + 1) / 2 ** 28 for i in range(k)] for w in words}

    def shares(p):
        total = [sum(v[i] for v in p.values()) + T.WORD_PRIOR * len(words) for i in range(k)]
        return {w: [(v[i] + T.WORD_PRIOR) / total[i] for i in range(k)] for w, v in p.items()}

    phi, theta = shares(phi), {i: [1 / k] * k for i in counts}
    for _ in range(rounds):
        by_word, by_doc = defaultdict(lambda: [0.0] * k), defaultdict(lambda: [0.0] * k)
        for d, c in counts.items():
            for w, n in c.items():
                s = sum(a * b for a, b in zip(theta[d], phi[w]))
                for i in range(k):
                    r = n * theta[d][i] * phi[w][i] / s
                    by_word[w][i] += r
                    by_doc[d][i] += r
        phi = shares(by_word)
        theta = {d: [(x + T.DOC_PRIOR) / (sum(v) + T.DOC_PRIOR * k) for x in v] for d, v in by_doc.items()}
    return phi, theta


def test_equals_plain_rounds(spark):
    docs = mixed(30, 2)
    model = T.fit_topics(spark.createDataFrame(docs, "doc_id long, text string"), k=3, rounds=4)
    phi, theta = plain_em(docs, 3, 4)
    got = {r["term"]: [r[f"p{i}"] for i in range(3)] for r in model.words.collect()}
    assert got.keys() == phi.keys()  # no word is left out
    assert all(math.isclose(a, b, rel_tol=1e-9) for w in phi for a, b in zip(got[w], phi[w]))
    got = {r["doc_id"]: [r[f"t{i}"] for i in range(3)] for r in model.documents.collect()}
    assert all(math.isclose(a, b, rel_tol=1e-9) for d in theta for a, b in zip(got[d], theta[d]))


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (3, "a b the")], [(1, "Orange"), (None, "orange Lemon lemon"), (1, "orange")]])
def test_odd_documents(spark, rows):
    model = T.fit_topics(spark.createDataFrame(rows, "doc_id long, text string"), k=2, rounds=3)
    worded = {w for _, t in rows for w in re.findall(r"\w{3,}", (t or "").lower())} - {"the"}
    assert {r["term"] for r in model.words.collect()} == worded
    assert len(T.top_terms(model, 3).collect()) == 2 * min(3, len(worded))


def test_blocks_give_what_one_block_gives(spark, monkeypatch):
    """Several blocks, rounds in several jobs, ids that come twice or are null, a word of more than 255 places."""
    docs = mixed(40, 3) + [(3, "apple1 engine2 again"), (None, "apple1 none " * 3), (None, "engine1 none"), (41, "often " * 700 + "seldom"), (42, ""), (43, None)]
    whole = {i: " ".join(t or "" for j, t in docs if j == i) for i, _ in docs}
    phi, theta = plain_em([(i, t) for i, t in whole.items() if t], 3, 7)
    for chars, at_once in ((1000, 3), (100_000_000, 7)):
        monkeypatch.setattr(T, "BLOCK_CHARS", chars)
        monkeypatch.setattr(T, "ROUNDS_PER_JOB", at_once)
        model = T.fit_topics(spark.createDataFrame(docs, "doc_id long, text string"), k=3, rounds=7)
        got = {r["term"]: [r[f"p{i}"] for i in range(3)] for r in model.words.collect()}
        assert got.keys() == phi.keys() and all(math.isclose(a, b, rel_tol=1e-9) for w in phi for a, b in zip(got[w], phi[w]))
        got = {r["doc_id"]: [r[f"t{i}"] for i in range(3)] for r in model.documents.collect()}
        assert got.keys() == theta.keys() and all(math.isclose(a, b, rel_tol=1e-9) for d in theta for a, b in zip(got[d], theta[d]))
        gains = [b - a for a, b in zip(model.posterior, model.posterior[1:])]
        assert len(model.posterior) == 7 and min(gains) > -1e-6


def test_rounds_move_words_and_not_counts(spark):
    """What a further round shuffles does not follow the number of (document, word) counts."""
    rng = random.Random(4)
    words = [f"w{i:04d}" for i in range(500)]
    docs = spark.createDataFrame([(i, " ".join(rng.sample(words, 300))) for i in range(600)], "doc_id long, text string").cache()
    folders = [pathlib.Path(d.getPath()) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffled(rounds):
        files = lambda: {p: p.stat().st_size for d in folders for p in d.rglob("shuffle_*.data")}
        before = files()
        T.fit_topics(docs, k=5, rounds=rounds)
        return sum(n for p, n in files().items() if p not in before)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables of any size
    try:
        a_round = (shuffled(5) - shuffled(1)) / 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        docs.unpersist()
    assert 0 < a_round < 2 * 600 * 300, a_round  # two bytes a count


def found_plainly(docs, terms):
    out = {}
    for i, t in docs:
        tokens = [w for w in re.split(r"[^\w]+", (t or "").lower()) if w]
        for term in {" ".join(w for w in re.split(r"[^\w]+", t.lower()) if w) for t in terms}:
            n = len(term.split())
            at = [k for k in range(len(tokens) - n + 1) if n and " ".join(tokens[k:k + n]) == term]
            if at:
                out[i, term] = len(at), at[0]
    return out


def test_term_mentions(spark):
    docs = [(1, "Machine learning: machine-learning, deep learning!"), (2, "GPT gpt-4 gpt"), (3, None), (4, ""), (5, "a a a a"), (6, "learn machines")]
    terms = ["machine learning", "Deep Learning", "gpt", "gpt 4", "a a", "", "  ", "none here", "learning", "GPT"]
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, term int")
    got = T.term_mentions(df, spark.createDataFrame([(t,) for t in [*terms, None]], "term string"))
    assert {(r["doc_id"], r["term"]): (r["mentions"], r["first_word"]) for r in got.collect()} == found_plainly(docs, terms)
    # As the short-list operator finds them.
    short = TX.topic_mentions(spark.createDataFrame(docs, "doc_id long, text string"), [t.lower() for t in terms if t.strip()])
    assert {(r["doc_id"], r["topic"]) for r in short.collect()} == {(r["doc_id"], r["term"]) for r in got.collect()}
    assert T.term_mentions(df, spark.createDataFrame([], "term string")).collect() == []
    assert T.term_mentions(df.limit(0), spark.createDataFrame([("a",)], "term string")).collect() == []


def test_many_terms_cost_what_few_do(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(2000)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, k=200))) for i in range(2000)], "doc_id long, text string").cache()
    docs.count()
    took = {}
    for n in (10, 100_000):
        terms = spark.createDataFrame([(f"w{i % 2000} w{i // 2000}",) for i in range(n)], "term string").cache()
        terms.count()
        times = []
        for _ in range(3):
            began = time.time()
            T.term_mentions(docs, terms, (2,)).write.format("noop").mode("overwrite").save()
            times.append(time.time() - began)
        took[n] = min(times)
    assert took[100_000] < 5 * took[10] + 2, took  # ten thousand times the terms
