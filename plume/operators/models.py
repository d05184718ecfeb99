"""Forecast, anomaly flags and data-quality checks (M1, M3–M5) in plain SQL
functions. All model fitting happens on hourly aggregates (networks × hours
rows), never on raw posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import as_of_lit, to_ntz

HOUR_S = 3600


def hourly_counts(df: DataFrame, as_of, days: int, ts: str = "created_at") -> DataFrame:
    """Posts per network and hour over the ``days`` before the clock, with
    empty hours present as 0.

    One pass: every busy hour of a network also gives the empty hours up to
    the next busy one (the first also those before it), by a window over the
    hourly counts. No self-join, no look-up, and the posts are read once."""
    now = F.date_trunc("hour", as_of_lit(as_of))
    lo = now - F.make_dt_interval(days=F.lit(days))
    recent = df.where((F.col(ts) >= lo) & (F.col(ts) < now))
    counts = recent.groupBy("source", F.date_trunc("hour", F.col(ts)).alias("busy")) \
        .agg(F.count(F.lit(1)).alias("n"))
    per, hour = Window.partitionBy("source").orderBy("busy"), F.expr("INTERVAL 1 HOUR")
    first = F.when(F.lag("busy").over(per).isNull(), lo).otherwise(F.col("busy"))
    last = F.coalesce(F.lead("busy").over(per), now) - hour
    spans = counts.withColumn("first", first).withColumn("last", last)
    grid = spans.select("source", "busy", "n", F.explode(F.sequence("first", "last", hour)).alias("hour"))
    return grid.select("source", "hour", F.when(F.col("hour") == F.col("busy"), F.col("n")).otherwise(0).cast("bigint").alias("posts"))


def _how(hour_col) -> F.Column:
    """Hour of week counted from the epoch (a Thursday)."""
    return F.pmod(F.floor(F.unix_seconds(hour_col) / HOUR_S), F.lit(168))


def forecast_volume(df: DataFrame, as_of, history_days: int = 30, horizon_hours: int = 168,
                    ts: str = "created_at") -> DataFrame:
    """M1: next ``horizon_hours`` per network = linear trend (least squares on
    the hourly history) + the mean residual of the same hour of week,
    floored at 0. The history needs at least one week so that every hour of
    week has a residual.

    Single pipeline over the hourly grid: the fit is a window aggregate per
    network, residuals are grouped per (network, hour of week), and each
    group emits the horizon hours that share its hour of week."""
    now = F.date_trunc("hour", as_of_lit(as_of))
    lo_s = F.unix_seconds(now - F.make_dt_interval(days=F.lit(history_days)))
    per = Window.partitionBy("source")
    # hours since the start of the history: keeps the fit well conditioned
    h = (hourly_counts(df, as_of, history_days, ts)
         .withColumn("x", (F.unix_seconds("hour") - lo_s) / HOUR_S)
         .withColumn("slope", F.regr_slope("posts", "x").over(per))
         .withColumn("intercept", F.regr_intercept("posts", "x").over(per))
         .withColumn("r", F.col("posts") - (F.col("intercept") + F.col("slope") * F.col("x"))))
    season = h.groupBy("source", _how(F.col("hour")).alias("how")).agg(
        F.avg("r").alias("season"), F.first("slope").alias("slope"), F.first("intercept").alias("intercept"))
    future = season.select("*", F.explode(F.sequence(now, now + F.make_dt_interval(hours=F.lit(horizon_hours - 1)),
                                                     F.expr("INTERVAL 1 HOUR"))).alias("hour")) \
        .where(_how(F.col("hour")) == F.col("how"))
    fc = F.greatest(F.col("intercept") + F.col("slope") * ((F.unix_seconds("hour") - lo_s) / HOUR_S)
                    + F.coalesce("season", F.lit(0.0)), F.lit(0.0))
    return future.select("source", to_ntz("hour").alias("hour"), F.round(fc, 4).alias("forecast"))


def anomaly_flag(df: DataFrame, as_of, days: int = 30, cutoff: float = 3.5,
                 ts: str = "created_at") -> DataFrame:
    """M3: robust z-score of hourly volume per network,
    z = 0.6745 · (x − median) / MAD; anomalous when |z| > cutoff.
    Medians are exact percentiles, taken as window aggregates over the
    hourly grid (networks × hours rows), so the posts are read once."""
    per = Window.partitionBy("source")
    h = hourly_counts(df, as_of, days, ts).withColumn("med", F.percentile("posts", 0.5).over(per))
    dev = h.withColumn("dev", F.abs(F.col("posts") - F.col("med"))) \
        .withColumn("mad", F.percentile("dev", 0.5).over(per))
    z = F.when(F.col("mad") > 0, 0.6745 * (F.col("posts") - F.col("med")) / F.col("mad")).otherwise(F.lit(0.0))
    return (dev.select("source", to_ntz("hour").alias("hour"), "posts", F.round(z, 4).alias("robust_z"))
            .withColumn("is_anomaly", F.abs(F.col("robust_z")) > cutoff))


def dq_checks(bronze: DataFrame, posts: DataFrame, as_of, keys=("source", "post_id"),
              known=("twitter", "reddit", "bluesky")) -> DataFrame:
    """M4/M5: one row per rule – failed rows, rows checked, failure rate.

    ``bronze`` gives the envelope rules, ``posts`` (silver before dedup) the
    post rules; the duplicate rule needs per-key counts. Posts are grouped
    once by key with every rule as a conditional count (partial aggregate,
    so a hot key is combined map-side), then summed; bronze is one more
    aggregate. Rules become rows with ``stack``."""
    now = as_of_lit(as_of)
    b = bronze.agg(
        F.count(F.lit(1)).alias("n_b"),
        F.count_if(~F.col("source").isin(list(known))).alias("unknown_source"),
        F.count_if(F.col("raw_data")["id"].isNull()).alias("missing_id"),
    )
    per_key = posts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("c"),
        F.count_if(F.col("created_at").isNull()).alias("bad_time"),
        F.count_if(F.col("created_at") > now).alias("future_time"),
        F.count_if(F.coalesce(F.col("engagement_score"), F.lit(0)) < 0).alias("negative_engagement"),
        F.count_if(F.coalesce(F.length(F.trim("text")), F.lit(0)) == 0).alias("empty_text"),
        F.count_if(F.col("likes").isNull()).alias("missing_metrics"),
    )
    rules = ["bad_time", "future_time", "negative_engagement", "empty_text", "missing_metrics"]
    p = per_key.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n_p"),
                    F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("duplicate_rows"),
                    *[F.coalesce(F.sum(r), F.lit(0)).alias(r) for r in rules])
    rules_b = b.select(F.expr("stack(2, 'unknown_source', unknown_source, n_b, 'missing_id', missing_id, n_b)"
                              " AS (rule, failed, checked)"))
    stacked = ", ".join(f"'{r}', CAST({r} AS BIGINT), CAST(n_p AS BIGINT)" for r in rules + ["duplicate_rows"])
    rules_p = p.select(F.expr(f"stack({len(rules) + 1}, {stacked}) AS (rule, failed, checked)"))
    out = rules_b.unionByName(rules_p)
    return out.withColumn("fail_rate", F.round(F.try_divide(F.col("failed"), F.col("checked")), 4))
