"""Unusual posts (M2, M3): an isolation forest over four features of a post.

The forest is fitted on a bounded sample (``TREES * SAMPLE`` posts, by md5 of
network and id): each tree isolates its share of it by splits at hashed places
between the least and the largest value of a hashed feature. So the same posts
give the same forest on every run. All posts are then scored by one expression
per tree, inside the JVM: a post that is isolated after few splits is unusual.
The share ``contamination`` with the highest scores is flagged; the cut is
exact, found by counting scores by their first three digits and then by six.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import as_of_lit
from ..session import Workspace
from . import text as TX

FEATURES = ["post_length", "engagement_rate", "keyword_count", "sentiment"]
TREES = 32
SAMPLE = 128
EULER = 0.5772156649
HASH = 1 << 28


def post_features(posts: DataFrame, as_of, terms, pos, neg) -> DataFrame:
    """M2 over silver posts: length of the cleaned text, engagement per hour of age (counted from one, at the clock),
    number of topics found in text and hashtags, and sentiment (share of positive less negative words)."""
    text = F.coalesce(F.col("text_clean"), F.lit(""))
    words = TX.word_tokens(text)
    age = F.greatest(F.unix_seconds(as_of_lit(as_of)) - F.unix_seconds("created_at"), F.lit(0)) / 3600
    hits = lambda of: F.size(F.filter(words, lambda w: w.isin(list(of))))
    topics = TX.with_topics(posts, terms)
    return topics.select(
        "source", "post_id", F.char_length(text).cast("double").alias("post_length"),
        F.coalesce(F.col("engagement_score") / (1 + F.coalesce(age, F.lit(0.0))), F.lit(0.0)).alias("engagement_rate"),
        F.coalesce(F.size("topics"), F.lit(0)).cast("double").alias("keyword_count"),
        ((hits(pos) - hits(neg)) / F.greatest(F.size(words), F.lit(1))).alias("sentiment"))


def sample_key() -> Column:
    return F.md5(F.concat_ws("|", "source", "post_id"))


def _number(name: str) -> int:
    return int(hashlib.md5(name.encode()).hexdigest()[:7], 16)


def average_path(n: int) -> float:
    """Mean depth at which one of n rows stands alone."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + EULER) - 2 * (n - 1) / n


def grow(rows: list[tuple[float, ...]], name: str, depth: int, limit: int):
    """A tree as (feature, threshold, below, from there on), or the path length of a leaf."""
    tree, code = name.split(":")
    n = len(rows[0]) if rows else 0
    first = _number(name)
    for j in ((first + k) % n for k in range(n if depth < limit and len(rows) > 1 else 0)):
        lo, hi = min(r[j] for r in rows), max(r[j] for r in rows)
        if lo < hi:
            at = lo + (hi - lo) * ((_number(f"{name}/") + 0.5) / HASH)
            sides = [[r for r in rows if r[j] < at], [r for r in rows if r[j] >= at]]
            return j, at, *(grow(side, f"{tree}:{code}{k}", depth + 1, limit) for k, side in enumerate(sides))
    return depth + average_path(len(rows))


def forest(features: DataFrame, trees: int = TREES, sample: int = SAMPLE) -> list:
    """The trees, from ``trees * sample`` rows at most."""
    kept = features.select(sample_key().alias("key"), *FEATURES).orderBy("key", *FEATURES).limit(trees * sample).collect()
    rows = [tuple(float(r[f]) for f in FEATURES) for r in kept]
    return [grow(rows[k::trees], f"{k}:", 0, math.ceil(math.log2(sample))) for k in range(trees)]


def path_length(tree) -> str:
    """A tree as a SQL expression."""
    if isinstance(tree, float):
        return f"{tree!r}D"
    j, at, below, above = tree
    return f"CASE WHEN {FEATURES[j]} < {at!r}D THEN {path_length(below)} ELSE {path_length(above)} END"


def anomaly_scores(features: DataFrame, trees: int = TREES, sample: int = SAMPLE) -> DataFrame:
    """Adds ``score``: 2 to the power of minus mean path over expected path, rounded to six places. About 0.5 is usual,
    towards 1 unusual."""
    # As elements of an array, each tree is compiled to a method of its own; as one sum they would outgrow a method.
    paths = F.array(*[F.expr(path_length(tree)) for tree in forest(features, trees, sample)])
    total = F.aggregate(paths, F.lit(0.0), lambda path, more: path + more)
    return features.withColumn("score", F.round(F.pow(F.lit(2.0), -(total / trees) / average_path(sample)), 6))


def flag_unusual(posts: DataFrame, contamination: float = 0.01) -> DataFrame:
    """Adds ``is_anomaly``: the ``contamination`` share of the posts with the highest scores, with all that tie."""
    wanted = math.ceil(contamination * posts.count())
    units = F.round(F.col("score") * 1_000_000).cast("bigint")
    above = low = 0
    for inside, digits in (("true", 1000), ("", 1)):
        # 1,001 rows at most, twice.
        counts = posts.where(inside or f"{low} <= round(score * 1000000) AND round(score * 1000000) < {low + 1000}") \
            .groupBy(F.floor(units / digits).alias("bin")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("bin")).collect()
        for row in counts:
            low = row["bin"] * digits
            if above + row["n"] >= wanted:
                break
            above += row["n"]
    return posts.withColumn("is_anomaly", units >= low)


def unusual_posts(posts: DataFrame, as_of, terms, pos, neg, contamination: float = 0.01) -> DataFrame:
    """M3: one row per post with its features, score and flag."""
    space = Workspace(posts.sparkSession, "outliers")
    features = space.put(post_features(posts, as_of, terms, pos, neg))
    return flag_unusual(space.put(anomaly_scores(features), features), contamination)
