"""Topic tables, ranks, bursts and period comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import as_of_lit, to_ntz

HOUR = "1 hour"


def _hour(ts: str = "created_at"):
    return F.date_trunc("hour", F.col(ts))


def hourly_volume_pivot(df: DataFrame, values=("twitter", "reddit", "bluesky"),
                        ts: str = "created_at") -> DataFrame:
    """Hour × network counts, one column per network. Pivot values are
    given, so Spark skips the extra distinct job and the plan is one agg."""
    return (df.where(F.col(ts).isNotNull()).groupBy(to_ntz(_hour(ts)).alias("hour"))
            .pivot("source", list(values)).agg(F.count(F.lit(1)))
            .select("hour", *[F.coalesce(F.col(v), F.lit(0)).alias(v) for v in values]))


def topic_hourly(df: DataFrame, topic_col: str = "topics", ts: str = "created_at") -> DataFrame:
    """Per topic × hour – mentions, engagement, trend score.
    ``topic_col`` is an array of topics per post (hashtags or K2 matches)."""
    t = df.where(F.col(ts).isNotNull()).select(
        F.explode(F.array_distinct(topic_col)).alias("topic"),
        to_ntz(_hour(ts)).alias("hour"), "engagement_score")
    return (t.groupBy("topic", "hour")
            .agg(F.count(F.lit(1)).alias("mention_count"),
                 F.sum("engagement_score").alias("total_engagement"))
            .withColumn("trend_score", F.round(F.col("total_engagement") / 100.0, 4)))


def topic_timeseries(topic_hour: DataFrame) -> DataFrame:
    """One row per topic and hour between its first and last hour, gaps
    filled with 0: every busy hour also gives the empty hours up to the next
    one, by a window over the topic's hours. One pass, no self-join and no
    look-up."""
    per, step = Window.partitionBy("topic").orderBy("hour"), F.expr("INTERVAL 1 HOUR")
    spans = topic_hour.withColumn("last", F.coalesce(F.lead("hour").over(per) - step, F.col("hour")))
    grid = spans.select("topic", F.col("hour").alias("busy"), "mention_count", "total_engagement",
                        F.explode(F.sequence("hour", "last", step)).alias("hour"))
    at = lambda c: F.when(F.col("hour") == F.col("busy"), F.col(c)).otherwise(0).alias(c)
    return grid.select("topic", "hour", at("mention_count"), at("total_engagement"))


def topic_rank(topic_hour: DataFrame, score: str = "trend_score", limit: int | None = None) -> DataFrame:
    """Dense rank of topics inside each hour (ties by topic name). With a ``limit`` only the best ranks are kept, and
    every task cuts to them before the shuffle; without one an hour's window holds all topics of that hour."""
    w = Window.partitionBy("hour").orderBy(F.desc(score), F.asc("topic"))
    rank = F.dense_rank().over(w)
    if limit is None:
        return topic_hour.withColumn("rank", rank.cast("bigint"))
    return topic_hour.withColumn("rank", rank).where(F.col("rank") <= limit).withColumn("rank", F.col("rank").cast("bigint"))


def top_posts_per_hour(df: DataFrame, k: int = 3, topic_col: str = "topics",
                       ts: str = "created_at") -> DataFrame:
    """The k most engaged posts per topic-hour, as rows (rank 1..k).
    ``row_number() <= k`` gets a map-side WindowGroupLimit, so a hot topic
    ships k rows per task, not its whole history."""
    t = df.where(F.col(ts).isNotNull()).select(
        F.explode(F.array_distinct(topic_col)).alias("topic"), to_ntz(_hour(ts)).alias("hour"),
        "source", "post_id", "engagement_score")
    w = Window.partitionBy("topic", "hour").orderBy(F.desc("engagement_score"), F.asc("post_id"), F.asc("source"))
    return t.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def burst_detect(df: DataFrame, lookback: int = 24, threshold: float = 2.0,
                 ts: str = "created_at") -> DataFrame:
    """Hourly posts per network against the mean of the hours with posts
    among the previous ``lookback`` hours; a burst when the ratio exceeds ``threshold``.
    Runs on the hourly aggregate (hours × networks rows), so the
    per-network window never sees raw posts."""
    hourly = (df.where(F.col(ts).isNotNull())
              .groupBy("source", to_ntz(_hour(ts)).alias("hour")).agg(F.count(F.lit(1)).alias("posts")))
    # Hours without posts have no row, so the frame goes by the clock.
    seconds = F.unix_seconds(F.col("hour").cast("timestamp"))
    w = Window.partitionBy("source").orderBy(seconds).rangeBetween(-lookback * 3600, -3600)
    base = F.avg("posts").over(w)
    return (hourly.withColumn("baseline", F.round(base, 4))
            .withColumn("ratio", F.round(F.col("posts") / base, 4))
            .withColumn("is_burst", F.coalesce(F.col("posts") / base > threshold, F.lit(False))))


def topic_burst(grid: DataFrame, lookback: int = 24, threshold: float = 2.0) -> DataFrame:
    """N3 per topic: hourly mentions on the gap-filled grid of
    :func:`topic_timeseries` against the mean of the previous ``lookback``
    hours, empty ones included; a burst when the ratio exceeds ``threshold``.
    A topic's window is its span in hours, however many posts it has."""
    w = Window.partitionBy("topic").orderBy("hour").rowsBetween(-lookback, -1)
    base = F.avg("mention_count").over(w)
    ratio = F.try_divide(F.col("mention_count"), base)
    return grid.select("topic", "hour", "mention_count", F.round(base, 4).alias("baseline"),
                       F.round(ratio, 4).alias("ratio"), F.coalesce(ratio > threshold, F.lit(False)).alias("is_burst"))


def heat_score(topic_hour: DataFrame, as_of, half_life_hours: float = 24.0) -> DataFrame:
    """Mentions × engagement ÷ time decay, decay = 2^(age_h / half_life).
    The decay form is not given anywhere; this exponential one is our choice."""
    age_h = (F.unix_seconds(as_of_lit(as_of)) - F.unix_seconds(F.col("hour").cast("timestamp"))) / 3600.0
    age_h = F.greatest(age_h, F.lit(0.0))
    return topic_hour.withColumn(
        "heat", F.round(F.col("mention_count") * F.col("total_engagement")
                        / F.pow(F.lit(2.0), age_h / half_life_hours), 4))


def period_change(df: DataFrame, ts: str = "created_at") -> DataFrame:
    """Daily totals with the change to the previous day in percent.
    ``lag`` runs over the daily aggregate (one row per day)."""
    daily = (df.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day"))
             .agg(F.count(F.lit(1)).alias("posts")))
    prev = F.lag("posts").over(Window.orderBy("day"))
    return (daily.withColumn("previous", prev)
            .withColumn("change_pct", F.round((F.col("posts") - F.col("previous")) * 100.0 / F.col("previous"), 4)))


def weekly_report(df: DataFrame, unit: str = "week", ts: str = "created_at") -> DataFrame:
    """Per week (or month) and network – posts, engagement, authors."""
    return (df.where(F.col(ts).isNotNull())
            .groupBy(to_ntz(F.date_trunc(unit, F.col(ts))).alias("period"), "source")
            .agg(F.count(F.lit(1)).alias("posts"),
                 F.sum("engagement_score").alias("total_engagement"),
                 F.countDistinct("author").alias("authors")))
