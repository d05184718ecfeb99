"""Runs against plain Python: every period's stretches of equal words, whatever the grammar."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plume.llm import registry, textbatch as T, word_runs as wr

SF = "/root/testdata/sf0.001"


def brute(words):
    """{(start, length, period)} by looking at every period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q) and j > i:
                found.setdefault((i, j - i + q), q)  # of equal stretches the smallest period
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def damaged(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    return words


def own_runs(texts):
    words = T.words(T.as_texts(pa.array(texts)))
    out = [[] for _ in texts]
    for text, *run in zip(*wr.runs_of(words)):
        out[text].append(tuple(map(int, run)))
    return out


def fibonacci(n):
    a, b = ["x"], ["x", "y"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue_morse(n):
    return ["ab"[bin(i).count("1") % 2] for i in range(n)]


def test_runs_of_structured_words():
    texts = [["w"] * n for n in (0, 1, 11, 12, 13, 200)]
    texts += [fibonacci(300), thue_morse(300), ["a", "b"] * 6, ["a", "b"] * 6 + ["a"], list("abcdef") * 2, list("abcde") * 2,
              list("abcdefg") * 2 + list("hij") * 5, list("aab") * 40, (["x"] * 13 + ["y"]) * 9, [str(i) for i in range(50)] * 2 + ["end"],
              [str(i) for i in range(40)]]
    got = own_runs([" ".join(t) for t in texts])
    for words, runs in zip(texts, got):
        assert runs == brute(words), words


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_runs_of_random_words(letters):
    rng = random.Random(letters)
    texts = []
    for _ in range(120):
        words = []
        while len(words) < 90:
            part = [rng.choice("abcdef"[:letters]) for _ in range(rng.randint(1, 14))]
            words += part * rng.randint(1, 6)
        texts.append(words[:rng.randint(0, 90)])
    assert own_runs([" ".join(t) for t in texts]) == [brute(t) for t in texts]


def test_runs_stop_at_the_end_of_a_text():
    assert own_runs(["a " * 7, "a " * 7, "b a " * 7]) == [[], [], [(0, 14, 2)]]


def test_one_boundary_run_for_all_places_of_a_nonterminal():
    words = T.words(T.as_texts(pa.array([" ".join([str(i) for i in range(100)] * 40)])))
    place, stretch = wr.repeated_places(words)
    symbols = np.unique(words.hash[place], return_inverse=True)[1].astype(np.int64)
    grammar = wr.repair(symbols, stretch)
    assert len(grammar.place) == len(symbols) - 1  # a binary tree over the words
    assert grammar.n < 4 * 100  # and few different nodes
    assert len(wr.boundary_runs(grammar, symbols)[0]) < 100
    assert wr.runs_of(words)[1:] == (0, 4000, 100)


def test_long_texts_take_time_in_proportion():
    rng = random.Random(3)
    block = [str(rng.random()) for _ in range(20_000)]
    text = " ".join(["w"] * 60_000 + block * 5 + thue_morse(30_000))
    (runs,) = own_runs([text])
    assert (0, 60_000, 1) in runs and (60_000, 100_000, 20_000) in runs


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {}
    for i, t in docs:
        words = damaged(i, t)
        runs = brute(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        lines = "".join("%d,%d,%d\n" % r for r in runs)
        want[i] = (len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(),
                   hashlib.sha256(collapsed(words, runs).encode()).hexdigest())
    got = registry.QUERIES["op13_word_runs"](spark, SF).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()
    assert {r[0]: tuple(r)[1:] for r in got} == want and len(got) == len(docs)
    assert sum(w[0] for w in want.values()) > 10


def test_nulls_extra_columns_repeated_rows_and_empty_tables(spark):
    rows = [(1, None, 1), (2, "", 2), (3, "  \t\n ", 3), (4, "ä\nö  " * 8, 4), (4, "ä\nö  " * 8, 4), (None, "x " * 20, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int").withColumn("Words_From", F.lit("no"))
    out = wr.find_runs(df)
    assert out.columns == ["doc_id", "text", "runs", "Words_From", "_runs", "collapsed"]
    got = sorted(((r["doc_id"], [tuple(x) for x in r["_runs"]], r["collapsed"]) for r in out.collect()), key=str)
    assert got == sorted([(1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 16, 2)], "ä ö"), (4, [(0, 16, 2)], "ä ö"),
                          (None, [(0, 20, 1)], "x")], key=str)
    assert wr.find_runs(df.limit(0)).collect() == []
    assert wr.repeat_tails(df.limit(0)).collect() == []
    assert [r["text"] for r in wr.repeat_tails(df).where("doc_id is null").collect()] == ["x " * 20]
