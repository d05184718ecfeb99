"""Dashboard views over unified posts: filters, sorts, limits, day groups, cards
(P6, P9–P11, T2–T4, T7, T8, A8, F8, F14, F15, F19, F20, F26)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions import text as T
from ..functions.time import age_bucket, as_of_lit, day_label


def filter_source(df: DataFrame, source: str | None) -> DataFrame:
    """One network; ``None`` / "all" means no filter."""
    if not source or source.lower() == "all":
        return df
    return df.where(F.col("source") == source)


def filter_communities(df: DataFrame, communities, col: str = "subreddit") -> DataFrame:
    """Multi-select; an empty selection means no filter. Only Reddit has communities, so only its partitions of a
    stored table are read."""
    communities = list(communities or [])
    if not communities:
        return df
    chosen = df.where(F.col(col).isin(communities))
    return chosen.where(F.col("source") == M.SOURCE_LABELS["reddit"]) if DATE in df.columns else chosen


#: Date that a stored table of posts is partitioned by; times are then bounded by it too, which prunes the scan.
DATE = "partition_date"


def _dated(df: DataFrame, low, high=None) -> DataFrame:
    """Only the partitions of the dates, where the table has such."""
    if DATE not in df.columns:
        return df
    out = df.where(F.col(DATE) >= F.to_date(low))
    return out if high is None else out.where(F.col(DATE) <= F.to_date(high))


def filter_period(df: DataFrame, period: str, as_of, ts: str = "created_ts") -> DataFrame:
    """All | today | yesterday | week (rolling 7 d) | month (rolling 30 d).

    Rows with an unparseable time survive "all" only (Q19); "week"/"month"
    are rolling windows, not calendar ones (Q17); the clock is ``as_of``.
    """
    now = as_of_lit(as_of)
    t = F.col(ts)
    if period == "all":
        return df
    if period == "today":
        return _dated(df, now, now).where(F.to_date(t) == F.to_date(now))
    if period == "yesterday":
        day = F.date_sub(F.to_date(now), 1)
        return _dated(df, day, day).where(F.to_date(t) == day)
    days = {"week": 7, "month": 30}.get(period)
    if days:
        low = now - F.make_dt_interval(days=F.lit(days))
        return _dated(df, low).where(t >= low)
    raise ValueError(f"unknown period {period!r}")


def filter_last_hours(df: DataFrame, hours: int, as_of, ts: str = "created_ts") -> DataFrame:
    """P10: the last n hours up to the clock (inclusive lower bound)."""
    now = as_of_lit(as_of)
    low = now - F.make_dt_interval(hours=F.lit(hours))
    return _dated(df, low, now).where((F.col(ts) >= low) & (F.col(ts) <= now))


def recent_posts(df: DataFrame, n: int = 50, ts: str = "created_ts", key: str = "post_id") -> DataFrame:
    """T2+T4/T8: newest first, unparseable times last, ties by id; top n
    (TakeOrderedAndProject: each task keeps n rows, the driver merges n·tasks)."""
    return df.orderBy(F.col(ts).desc_nulls_last(), F.col(key).asc(), F.col("source").asc()).limit(n)


def hottest_posts(df: DataFrame, n: int = 50, key: str = "post_id") -> DataFrame:
    """T3 (= "most engaged", Q18): engagement desc, ties by id; top n."""
    return df.orderBy(F.col("engagement").desc_nulls_last(), F.col(key).asc(), F.col("source").asc()).limit(n)


most_engaged_posts = hottest_posts


def history_cap(df: DataFrame, group: str, order_cols, keep: int = 5_000, above: int = 10_000) -> DataFrame:
    """A group of more than ``above`` rows is trimmed to its first ``keep``;
    smaller ones stay whole. A group is dealt out by a hash of its rows first,
    and each part keeps ``above + 1`` rows at most, so no task sorts a whole
    hot group; what is left tells whether the group is over the mark."""
    part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(64))
    near = df.withColumn("_part", part).withColumn("_r", F.row_number().over(
        Window.partitionBy(group, "_part").orderBy(*order_cols))).where(F.col("_r") <= above + 1).drop("_part")
    w = Window.partitionBy(group).orderBy(*order_cols)
    ranked = near.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= above + 1)
    size = F.max("_r").over(Window.partitionBy(group))
    return ranked.withColumn("_n", size).where((F.col("_n") <= above) | (F.col("_r") <= keep)).drop("_r", "_n")


def cap_per_group(df: DataFrame, group: str, n: int, order_cols) -> DataFrame:
    """At most n rows per group. ``row_number() <= n`` lets Spark insert
    a per-partition WindowGroupLimit before the shuffle, so a hot group ships
    only n rows per map task, never the whole group."""
    w = Window.partitionBy(group).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def posts_by_day(df: DataFrame, as_of, ts: str = "created_ts") -> DataFrame:
    """Count per calendar day with a relative label, oldest day first;
    rows without a parseable time are left out of the grouping (Q19)."""
    day = F.to_date(F.col(ts))
    return (df.where(F.col(ts).isNotNull()).groupBy(day.alias("day"))
            .agg(F.count(F.lit(1)).alias("posts"))
            .withColumn("label", day_label(F.col("day"), as_of))
            .orderBy("day"))


def card_fields(df: DataFrame, as_of) -> DataFrame:
    """Render-ready card columns: snippet (F8), meta line (F14, F19), badge
    (F26), formatted engagement (F15). Text is cleaned once (Q12)."""
    sub = F.col("subreddit")
    meta = F.concat_ws(
        " • ",
        F.when(sub.isNotNull() & (sub != ""), F.concat(F.lit("r/"), sub)),
        F.concat(F.lit("by u/"), F.coalesce(F.col("author"), F.lit("Unknown"))),
        age_bucket(F.col("created_ts"), as_of),
    )
    return df.select(
        "source", "post_id",
        M.badge_class(F.col("source")).alias("badge"),
        meta.alias("meta"),
        T.snippet(F.col("text")).alias("snippet"),
        T.thousands(M.z("engagement")).alias("engagement_label"),
    )
