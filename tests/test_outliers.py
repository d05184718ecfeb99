"""Isolation forest over posts (M2, M3)."""

import hashlib
import math
import random

import pytest

from plume.operators import outliers as O

SCHEMA = "source string, post_id string, post_length double, engagement_rate double, keyword_count double, sentiment double"


def posts(n=2000, spam=20, seed=1):
    rng = random.Random(seed)
    rows = [("twitter", str(i), rng.gauss(80, 15), rng.expovariate(1 / 3), float(rng.choice([0, 0, 1, 1, 2])), rng.choice([0.0, 0.0, 0.05, -0.05]))
            for i in range(n - spam)]
    rows += [("bluesky", f"spam{i}", rng.uniform(600, 900), rng.uniform(80, 200), float(rng.randint(9, 20)), rng.uniform(0.5, 0.9)) for i in range(spam)]
    rng.shuffle(rows)
    return rows


def plain_scores(rows, trees, sample):
    """The same forest written without the operator: recursion over lists, one row at a time."""
    order = sorted(rows, key=lambda r: (hashlib.md5(f"{r[0]}|{r[1]}".encode()).hexdigest(), r[2:]))[:trees * sample]

    def number(text):
        return int(hashlib.md5(text.encode()).hexdigest()[:7], 16)

    def average(n):
        return 0 if n < 2 else 1 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def path(x, inside, tree, code):
        if len(code) < math.ceil(math.log2(sample)) and len(inside) > 1:
            start = number(f"{tree}:{code}") % 4
            for j in [(start + k) % 4 for k in range(4)]:
                values = [r[j] for r in inside]
                if min(values) < max(values):
                    cut = min(values) + (max(values) - min(values)) * ((number(f"{tree}:{code}/") + 0.5) / 2 ** 28)
                    side = x[j] >= cut
                    return path(x, [r for r in inside if (r[j] >= cut) == side], tree, code + "01"[side])
        return len(code) + average(len(inside))

    parts = [[r[2:] for r in order[k::trees]] for k in range(trees)]
    return {r[:2]: round(2 ** (-sum(path(r[2:], p, k, "") for k, p in enumerate(parts)) / trees / average(sample)), 6) for r in rows}


def test_scores_equal_a_plain_forest(spark):
    rows = posts(400, 4)
    got = O.anomaly_scores(spark.createDataFrame(rows, SCHEMA), trees=9, sample=32).collect()
    want = plain_scores(rows, 9, 32)
    assert len(got) == len(rows) and all(abs(r["score"] - want[r["source"], r["post_id"]]) < 2e-6 for r in got)


def test_planted_spam_is_flagged(spark):
    rows = posts()
    out = O.flag_unusual(O.anomaly_scores(spark.createDataFrame(rows, SCHEMA)), 0.01).collect()
    flagged = {r["post_id"] for r in out if r["is_anomaly"]}
    assert len(out) == len(rows) and len(flagged) == 20
    assert sum(i.startswith("spam") for i in flagged) >= 18
    spam, usual = ([r["score"] for r in out if r["post_id"].startswith("spam") == k] for k in (True, False))
    assert sum(spam) / len(spam) > sum(usual) / len(usual) + 0.1


def test_the_cut_is_exact_and_takes_ties(spark):
    for scores in ([0.5] * 50, [k / 1e6 for k in range(400_000, 400_300)], [0.1, 0.9, 0.9, 0.9], [0.123456]):
        df = spark.createDataFrame([(s,) for s in scores], "score double")
        for share in (0.01, 0.5, 1.0):
            cut = sorted(scores, reverse=True)[math.ceil(share * len(scores)) - 1]
            assert sorted((r["score"], r["is_anomaly"]) for r in O.flag_unusual(df, share).collect()) == sorted((s, s >= cut) for s in scores)


def test_trees_are_bounded_by_the_sample(spark):
    df = spark.createDataFrame(posts(), SCHEMA)

    def leaves(tree):
        return 1 if isinstance(tree, float) else leaves(tree[2]) + leaves(tree[3])

    trees = O.forest(df, 5, 64)
    assert len(trees) == 5 and all(1 < leaves(t) <= 64 for t in trees)


def test_features_of_odd_posts(spark):
    rows = [("twitter", "1", None, None, None, None), ("twitter", "2", "", [], 5, "2024-01-30 11:00:00"), (None, None, "Update up up score!", ["Click", "UPDATE"], 30, "2024-01-30 10:00:00")]
    df = spark.createDataFrame(rows, "source string, post_id string, text_clean string, hashtags array<string>, engagement_score bigint, t string")
    df = df.selectExpr("*", "cast(t as timestamp) as created_at")
    args = ("2024-01-30 12:00:00", ["update", "click"], ["up"], ["score"])
    got = {r["post_id"]: tuple(r)[2:] for r in O.post_features(df, *args).collect()}
    assert got == {"1": (0, 0, 0, 0), "2": (0, 2.5, 0, 0), None: (19, 10, 2, 0.25)}
    out = O.unusual_posts(df, *args).collect()
    assert len(out) == 3 and any(r["is_anomaly"] for r in out)


@pytest.mark.parametrize("rows", [[], [("a", "1", 1.0, 1.0, 1.0, 1.0)], [("a", str(i), 1.0, 1.0, 1.0, 1.0) for i in range(9)]])
def test_empty_and_constant_tables(spark, rows):
    out = O.flag_unusual(O.anomaly_scores(spark.createDataFrame(rows, SCHEMA))).collect()
    assert len(out) == len(rows) and all(r["is_anomaly"] for r in out)
