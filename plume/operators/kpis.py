"""Dashboard and collector aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import SOURCE_LABELS


def count_by_source(df: DataFrame, col: str = "source") -> DataFrame:
    """A1: running count per source (batch or complete-mode stream)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("post_count"))


def source_share(df: DataFrame, col: str = "source") -> DataFrame:
    """A4/Q20: posts and percent per source; all sources, so shares add to 100.

    The percent needs the grand total: a window over the already aggregated
    rows (one per source), never over the posts themselves.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("posts"))
    total = F.sum("posts").over(Window.partitionBy())
    return counts.select(col, "posts", F.round(F.try_divide(F.col("posts") * 100.0, total), 4).alias("share_pct"))


def kpi_totals(df: DataFrame, labels=tuple(SOURCE_LABELS.values())) -> DataFrame:
    """A5: one row – total posts, posts per network, total engagement."""
    per = [F.count_if(F.col("source") == lab).alias(f"{lab.lower()}_posts") for lab in labels]
    return df.agg(F.count(F.lit(1)).alias("total_posts"), *per,
                  F.coalesce(F.sum("engagement"), F.lit(0)).cast("bigint").alias("total_engagement"))


def new_since(df: DataFrame, previous_refresh, ts: str = "topic_timestamp") -> DataFrame:
    """Total now, the count at the previous refresh, and the difference.
    The snapshot is a predicate on arrival time, so no driver state is kept."""
    prev = F.lit(str(previous_refresh)).cast("timestamp")
    return (df.agg(F.count(F.lit(1)).alias("total_posts"),
                   F.count_if(F.col(ts) <= prev).alias("previous_count"))
            .withColumn("new_posts", F.col("total_posts") - F.col("previous_count")))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Selector options (non-NULL distinct values)."""
    return df.where(F.col(col).isNotNull()).select(col).distinct()


def count_by(df: DataFrame, *cols: str, name: str = "posts") -> DataFrame:
    """A9 and friends: plain group count."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def user_activity(df: DataFrame, author: str = "author", ts: str = "created_at") -> DataFrame:
    """Per author – posts, total and mean engagement, active days, networks."""
    return df.groupBy(author).agg(
        F.count(F.lit(1)).alias("posts"),
        F.sum("engagement_score").alias("total_engagement"),
        F.round(F.avg("engagement_score"), 4).alias("avg_engagement"),
        F.countDistinct(F.to_date(ts)).alias("active_days"),
        F.countDistinct("source").alias("networks"),
    )


def top_authors(df: DataFrame, n: int = 10, author: str = "author") -> DataFrame:
    """Most active authors, ties by name."""
    return (df.groupBy(author).agg(F.count(F.lit(1)).alias("posts"),
                                   F.sum("engagement_score").alias("total_engagement"))
            .orderBy(F.desc("posts"), F.desc("total_engagement"), F.asc(author)).limit(n))


def influencers(df: DataFrame, n: int = 10, author: str = "author") -> DataFrame:
    """Authors ranked by total engagement (dense rank, ties share a rank).
    The rank is global, so it runs on the per-author aggregate, cut to the
    n best by a TakeOrdered first: the window sees n rows, not all authors."""
    agg = (df.groupBy(author).agg(F.sum("engagement_score").alias("total_engagement"),
                                  F.round(F.avg("engagement_score"), 4).alias("avg_engagement"),
                                  F.count(F.lit(1)).alias("posts"))
           .orderBy(F.desc("total_engagement"), F.asc(author)).limit(n))
    w = Window.orderBy(F.desc("total_engagement"))
    return agg.withColumn("rank", F.dense_rank().over(w).cast("bigint"))


def collection_tally(df: DataFrame, community: str = "community") -> DataFrame:
    """Per network – posts collected, communities that yielded posts and
    communities attempted (a community with only failed rows counts as tried)."""
    return df.groupBy("source").agg(
        F.count(F.lit(1)).alias("collected"),
        F.countDistinct(F.when(F.col("post_id").isNotNull(), F.col(community))).alias("communities_ok"),
        F.countDistinct(community).alias("communities_tried"),
    )


def high_water_mark(df: DataFrame, id_col: str = "post_id") -> DataFrame:
    """The largest numeric id seen per network (not the first one)."""
    return df.groupBy("source").agg(F.max(F.col(id_col).try_cast("bigint")).alias("since_id"))


def read_marks(df: DataFrame, id_col: str = "post_id", ts: str = "created_at") -> DataFrame:
    """The last post read of each network, by (time, id). Ids of some networks
    are base 36 or no numbers at all, so time comes first and ids, as text,
    only order posts of one moment."""
    return df.where(F.col(ts).isNotNull()).groupBy("source").agg(F.max(F.struct(ts, id_col)).alias("since"))


def incremental_since(df: DataFrame, marks: DataFrame, id_col: str = "post_id", ts: str = "created_at") -> DataFrame:
    """Rows behind each network's mark, one row per network in ``marks``
    (:func:`read_marks`). Rows without a time, and networks without a mark,
    are always read again rather than lost."""
    newer = F.struct(ts, id_col) > F.col("since")
    return (df.join(marks, "source", "left")
            .where(F.col("since").isNull() | F.col(ts).isNull() | newer).drop("since"))


def parse_yield(decoded: DataFrame) -> DataFrame:
    """Records read, envelopes parsed, posts of a known network."""
    known = list(SOURCE_LABELS)
    return decoded.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("source").isNotNull()).alias("parsed"),
        F.count_if(F.col("source").isin(known)).alias("known_source"),
    ).withColumn("parse_rate", F.round(F.try_divide(F.col("parsed"), F.col("records")), 4))


def dedup_rate(df: DataFrame, keys=("source", "post_id")) -> DataFrame:
    """Share of duplicate deliveries per network, 1 - distinct/rows.
    Distinct keys are counted by a two-level aggregate (no giant set)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return (per_key.groupBy(keys[0]).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"))
            .withColumn("dup_rate", F.round(1 - F.col("distinct_keys") / F.col("rows"), 4)))
