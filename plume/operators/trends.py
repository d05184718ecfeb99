"""Gold layer: windowed trend aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import to_ntz


def trending_windows(silver: DataFrame, window: str = "1 hour", slide: str = "30 minutes",
                     watermark: str | None = None, time_col: str = "created_at") -> DataFrame:
    """A2+A3: count, total, mean engagement per sliding window × source.

    ``trend_score = post_count · avg_engagement / 100`` (equals total/100
    when nothing is NULL, Q26). No global sort inside: a sorted aggregate is
    only legal in complete mode (Q7) – sort when reading (``trending_top``).
    Post ids are *not* collected per window (one hot window would put
    millions of ids in one row); the long form is ``window_posts``.
    """
    df = silver.where(F.col(time_col).isNotNull())
    if watermark:
        df = df.withWatermark(time_col, watermark)
    agg = df.groupBy(F.window(time_col, window, slide).alias("w"), "source").agg(
        F.count(F.lit(1)).alias("post_count"),
        F.sum("engagement_score").alias("total_engagement"),
        F.avg("engagement_score").alias("_avg"),
    )
    return agg.select(
        to_ntz(F.col("w.start")).alias("window_start"), to_ntz(F.col("w.end")).alias("window_end"),
        "source", "post_count", "total_engagement",
        F.round("_avg", 4).alias("avg_engagement"),
        F.round(F.col("post_count") * F.col("_avg") / 100, 4).alias("trend_score"),
    )


def window_posts(silver: DataFrame, window: str = "1 hour", slide: str = "30 minutes",
                 time_col: str = "created_at") -> DataFrame:
    """The ``post_ids`` of A2 in long form: one row per (window, source, post).
    A narrow projection + generator, no shuffle and no per-window array."""
    w = F.window(time_col, window, slide)
    return (silver.where(F.col(time_col).isNotNull())
            .select(w.alias("w"), "source", "post_id")
            .select(to_ntz(F.col("w.start")).alias("window_start"), "source", "post_id"))


def trending_top(gold: DataFrame, n: int = 10) -> DataFrame:
    """Highest trend scores first, read side (ties by window, source)."""
    return gold.orderBy(F.desc("trend_score"), F.asc("window_start"), F.asc("source")).limit(n)


def _hour_groups(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("created_at").isNotNull()).withColumn(
        "hour", F.window("created_at", "1 hour").start).withColumn(
        "community", F.coalesce("community", F.lit("")))


def hourly_stats(silver: DataFrame, sentiment_col: str | None = None) -> DataFrame:
    """Tumbling hour × source × community: count, mean sentiment and
    total engagement, in one partial aggregate."""
    sent = F.avg(sentiment_col) if sentiment_col else F.lit(None).cast("double")
    agg = _hour_groups(silver).groupBy("hour", "source", "community").agg(
        F.count(F.lit(1)).alias("post_count"), F.round(sent, 4).alias("avg_sentiment"),
        F.sum("engagement_score").alias("total_engagement"))
    return agg.withColumn("hour", to_ntz(F.col("hour")))


def hourly_keywords(silver: DataFrame, keywords_col: str = "topics") -> DataFrame:
    """The keywords of A10 in long form: every keyword of every hour × source
    × community with its count. A partial aggregate; nothing is cut, and no
    group builds a list."""
    return (_hour_groups(silver).select("hour", "source", "community", F.explode(keywords_col).alias("keyword"))
            .groupBy("hour", "source", "community", "keyword").agg(F.count(F.lit(1)).alias("mentions"))
            .withColumn("hour", to_ntz(F.col("hour"))))
