"""Jaccard join against all pairs by brute force; components against union-find; skewed and odd inputs."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plume.llm import jaccard_join as jj, linking, registry
from plume.plans.verify import compare, duck

SF = "/root/testdata/sf0.001"


def shingles(text):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def union(nodes, links):
    label = {n: n for n in nodes}

    def top(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        label[b] = a
    return {n: top(n) for n in nodes}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    posts = {}
    for k, s in enumerate(sets):
        for x in s:
            posts.setdefault(x, []).append(k)
    shared = Counter((a, b) for own in posts.values() for i, a in enumerate(own) for b in own[i + 1:])
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    of = union(range(len(rows)), links)
    smallest = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            smallest[of[k]] = min(i, smallest.get(of[k], i))
    return Counter((i, len(sets[k]), smallest.get(of[k])) for k, (i, _) in enumerate(rows)), of


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 5) for r in rows], "doc_id long, text string, node string, `si.ze` int")


def check(spark, rows, keep=True):
    df = frame(spark, rows)
    want, of = brute(rows)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jj.classes(df).collect())
    assert got == want
    if not keep:
        return
    kept = jj.keep_one(df)
    assert kept.columns == df.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert set(left) <= set(rows)
    if all(i is not None for i, _ in rows):
        heads = sum(1 for k in set(of.values()))
        assert len(left) == heads


def mutate(rng, words, n):
    out = list(words)
    for _ in range(n):
        k = rng.randrange(len(out) or 1)
        out[k:k + 1] = rng.choice(([], [f"n{rng.randrange(10**6)}"], [*out[k:k + 1], f"n{rng.randrange(10**6)}"]))
    return out


@pytest.mark.parametrize("light", [None, 12])
def test_near_copies_of_all_sizes(spark, monkeypatch, light):
    if light is not None:
        monkeypatch.setattr(jj, "boundary", lambda sizes, counts: light)
    rng = random.Random(9)
    rows, i = [], 0
    common = [f"c{k}" for k in range(60)]
    for size in (1, 3, 5, 8, 9, 10, 14, 25, 50, 70, 120, 300):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for n in (0, 0, 1, 1, 2, 3, size // 20, size // 12):
            ws = mutate(rng, base, n)
            rows.append((i, " ".join(ws)))
            rows.append((i + 1, " ".join([*common, *ws])))
            i += 2
    rng.shuffle(rows)
    check(spark, rows, keep=light is None)


def test_chains_and_copies(spark):
    rng = random.Random(2)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for k in range(40):  # each like the one before, the ends unlike
        rows.append((500 - k, " ".join(base)))
        base = mutate(rng, base, 1)
    rows += [(1000 + k, "Same TEXT here for all of the copies") for k in range(300)]
    rows += [(2000 + k, " ".join([f"p{j}" for j in range(40)] + [f"q{k}"])) for k in range(200)]
    check(spark, rows)


def test_odd_texts(spark):
    check(spark, [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE "), (6, "one two"), (7, "\x85 a\xa0b"), (8, "a\xa0b \x85"),
                  (9, "x " * 50000), (10, "x " * 7), (11, "É é"), (12, "é é")])
    check(spark, [(1, "a b c"), (1, "a b c"), (1, "other"), (2, "A b c"), (None, "null id"), (None, "null id"), (3, None), (3, None), (None, None)])


def test_stored_documents(spark):
    ok, detail = compare(registry.op5_jaccard_join(spark, SF), duck(SF), registry.ORACLE_SQL["op5_jaccard_join"])
    assert ok, detail


def test_whole_sets_take_disk_once(spark, monkeypatch):
    """Both joins of a verification read one shuffle of the sets; no copy of them is stored beside it."""
    rng, keep, plans = random.Random(5), jj.stored, []

    def stored(df, name, *rest):
        assert "set" not in df.columns
        if name == "verified":
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, name, *rest)

    monkeypatch.setattr(jj, "stored", stored)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = [f"w{k}" for k in range(100)]
        got = jj.classes(frame(spark, [(k, " ".join(mutate(rng, base, 1))) for k in range(12)])).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r["component_id"] for r in got} == {0}
    assert plans and all("ReusedExchange" in p or "ReusedQueryStage" in p for p in plans)


def test_empty_table(spark):
    df = frame(spark, [])
    assert jj.classes(df).collect() == [] and jj.keep_one(df).collect() == []


def test_components(spark):
    rng = random.Random(3)
    for links in ([], [(1, 2)], [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 80)],
                  [tuple(sorted(rng.sample(range(120), 2))) for _ in range(70)], [(5, 9), (5, 9), (7, 8)]):
        got = {r["node"]: r["label"] for r in linking.components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert got == union({n for e in links for n in e}, links)


def test_boundary_follows_the_cost():
    flat = np.full(1 << jj.ORDER_BITS, 3)
    assert jj.boundary({10: 1000, 30: 1000, 200: 1000}, flat) < 10
    lists = np.zeros(1 << jj.ORDER_BITS, int)
    lists[::3] = np.random.default_rng(1).integers(0, 60, len(lists[::3]))
    assert jj.boundary({10: 1000, 30: 1000, 200: 1000}, lists) >= 30


def test_no_group_is_expanded(spark):
    """A group of n near copies gives pairs in proportion to n, not to its square."""
    made = []
    def verify(pairs):
        made.append(pairs.count())
        return pairs
    posts = spark.range(400).select(F.lit(7).cast("long").alias("key"), F.col("id").alias("node"), F.lit(0).alias("class"), F.lit(0).alias("rank"),
                                    F.lit(True).alias("indexed"))
    labels = linking.link(posts, verify, lambda a, b: F.lit(True), lambda a, b: F.lit(True), [])
    assert {r["label"] for r in labels.collect()} == {0} and made == [399, 0]
