"""Silver layer: typed, cleaned, deduplicated posts per network (P5–P16, U*, J1–J3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from ..functions import metrics as M
from ..functions import text as T
from ..functions.time import parse_time
from ..schemas import BLUESKY_METRICS, REDDIT_METRICS, TWITTER_METRICS

_STR_ARRAY = ArrayType(StringType())
# Languages kept by the Twitter silver path.
SILVER_LANGUAGES = ["en", "zh"]


def _raw(k: str) -> Column:
    return F.col("raw_data").getItem(k)


def _arr(k: str) -> Column:
    return F.coalesce(F.from_json(_raw(k), _STR_ARRAY), F.array().cast(_STR_ARRAY))


def _common(source: str, text: Column, text_clean: Column, author: Column, author_id: Column,
            created: Column, language: Column, community: Column, likes: Column,
            shares: Column, replies: Column, quotes: Column, hashtags: Column,
            mentions: Column, strict: bool) -> list[Column]:
    src = F.lit(source)
    return [
        src.alias("source"), _raw("id").alias("post_id"), text.alias("text"),
        text_clean.alias("text_clean"), author.alias("author"), author_id.alias("author_id"),
        parse_time(created).alias("created_at"), language.alias("language"),
        community.alias("community"),
        likes.alias("likes"), shares.alias("shares"), replies.alias("replies"), quotes.alias("quotes"),
        M.engagement_score(src, likes, shares, replies, quotes, strict).alias("engagement_score"),
        M.engagement(src, likes, shares).alias("engagement"),
        hashtags.alias("hashtags"), mentions.alias("mentions"),
        F.coalesce(F.size(hashtags), F.lit(0)).cast("bigint").alias("num_hashtags"),
        F.coalesce(F.size(mentions), F.lit(0)).cast("bigint").alias("num_mentions"),
        F.col("processed_at"),
    ]


def _coords(bronze: DataFrame) -> list[str]:
    return [c for c in ("topic_partition", "topic_offset") if c in bronze.columns]


def silver_twitter(bronze: DataFrame, strict: bool = False, languages=SILVER_LANGUAGES) -> DataFrame:
    """Twitter rows: URL/mention/'#' cleaning, silver score, language filter."""
    m = F.from_json(_raw("metrics"), TWITTER_METRICS)
    text = _raw("text")
    cols = _common("twitter", text, T.clean_twitter(text), _raw("author_username"), _raw("author_id"),
                   _raw("created_at"), _raw("language"), F.lit(None).cast("string"),
                   m["likes"], m["retweets"], m["replies"], m["quotes"],
                   _arr("hashtags"), _arr("mentions"), strict)
    out = bronze.where(F.col("source") == "twitter").select(*cols, *_coords(bronze))
    if languages:
        out = out.where(F.col("language").isin(list(languages)))
    return out


def silver_reddit(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """Reddit rows: full text = title + text (F4), URL cleaning, score + 2·comments."""
    m = F.from_json(_raw("metrics"), REDDIT_METRICS)
    full = F.concat_ws(" ", _raw("title"), _raw("text"))
    cols = _common("reddit", full, T.clean_reddit(full), _raw("author"), _raw("author"),
                   _raw("created_utc"), F.lit("en"), _raw("subreddit"),
                   m["score"], F.lit(None).cast("bigint"), m["num_comments"], F.lit(None).cast("bigint"),
                   F.array().cast(_STR_ARRAY), F.array().cast(_STR_ARRAY), strict)
    return bronze.where(F.col("source") == "reddit").select(*cols, *_coords(bronze))


def silver_bluesky(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """Bluesky rows (Q6): missing language → en (F31), twitter-style weights."""
    m = F.from_json(_raw("metrics"), BLUESKY_METRICS)
    text = _raw("text")
    cols = _common("bluesky", text, T.clean_twitter(text), _raw("author_handle"), _raw("author_did"),
                   _raw("created_at"), F.coalesce(_raw("language"), F.lit("en")), F.lit(None).cast("string"),
                   m["likes"], m["reposts"], m["replies"], m["quotes"],
                   _arr("hashtags"), _arr("mentions"), strict)
    return bronze.where(F.col("source") == "bluesky").select(*cols, *_coords(bronze))


ALL_METRICS = StructType([StructField(n, LongType()) for n in
                          ("likes", "retweets", "replies", "quotes", "score", "num_comments", "reposts")]
                         + [StructField("upvote_ratio", DoubleType())])


def silver_posts(bronze: DataFrame, strict: bool = False, languages=SILVER_LANGUAGES) -> DataFrame:
    """All three networks in one pass over bronze – the same rows and columns
    as the union of the per-network functions, but each envelope's metrics
    are parsed once (superset schema) and bronze is scanned once."""
    src = F.col("source")
    tw, rd = src == "twitter", src == "reddit"
    m = F.from_json(_raw("metrics"), ALL_METRICS)

    def pick(t, r, b):
        return F.when(tw, t).when(rd, r).otherwise(b)
    text = pick(_raw("text"), F.concat_ws(" ", _raw("title"), _raw("text")), _raw("text"))
    clean = F.when(rd, T.clean_reddit(text)).otherwise(T.clean_twitter(text))
    none_s, none_l = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    empty = F.array().cast(_STR_ARRAY)
    likes = pick(m["likes"], m["score"], m["likes"])
    shares = pick(m["retweets"], none_l, m["reposts"])
    replies = pick(m["replies"], m["num_comments"], m["replies"])
    quotes = pick(m["quotes"], none_l, m["quotes"])
    hashtags = F.when(rd, empty).otherwise(_arr("hashtags"))
    mentions = F.when(rd, empty).otherwise(_arr("mentions"))
    cols = [
        src.alias("source"), _raw("id").alias("post_id"), text.alias("text"), clean.alias("text_clean"),
        pick(_raw("author_username"), _raw("author"), _raw("author_handle")).alias("author"),
        pick(_raw("author_id"), _raw("author"), _raw("author_did")).alias("author_id"),
        parse_time(pick(_raw("created_at"), _raw("created_utc"), _raw("created_at"))).alias("created_at"),
        pick(_raw("language"), F.lit("en"), F.coalesce(_raw("language"), F.lit("en"))).alias("language"),
        F.when(rd, _raw("subreddit")).otherwise(none_s).alias("community"),
        likes.alias("likes"), shares.alias("shares"), replies.alias("replies"), quotes.alias("quotes"),
        M.engagement_score(src, likes, shares, replies, quotes, strict).alias("engagement_score"),
        M.engagement(src, likes, shares).alias("engagement"),
        hashtags.alias("hashtags"), mentions.alias("mentions"),
        F.coalesce(F.size(hashtags), F.lit(0)).cast("bigint").alias("num_hashtags"),
        F.coalesce(F.size(mentions), F.lit(0)).cast("bigint").alias("num_mentions"),
        F.col("processed_at"),
    ]
    keep = src.isin("twitter", "reddit", "bluesky")
    if languages:
        keep = keep & (~tw | _raw("language").isin(list(languages)))
    return bronze.where(keep).select(*cols, *_coords(bronze))


def silver_all(bronze: DataFrame, dedup: bool = True, strict: bool = False, columns=None) -> DataFrame:
    """All three networks in one schema, deduplicated on (source, post_id).

    ``columns`` narrows the rows *before* the dedup: the optimizer cannot
    prune fields out of the struct the dedup aggregate carries, so a caller
    that needs four columns should not shuffle twenty (text included)."""
    out = silver_posts(bronze, strict)
    if columns:
        keep = ["source", "post_id"] + [c for c in columns if c not in ("source", "post_id")]
        keep += [c for c in ("topic_offset", "topic_partition") if c in out.columns and c not in keep]
        out = out.select(*keep)
    return dedup_posts(out) if dedup else out


def dedup_posts(df: DataFrame, keys=("source", "post_id"), order=("topic_offset", "topic_partition"),
                watermark: str = "10 minutes", event_time: str = "created_at") -> DataFrame:
    """One row per key.

    Batch: the earliest delivery wins (lowest topic offset), chosen by a
    ``min_by`` aggregate – hash-partial, so a key repeated a billion times is
    combined map-side instead of landing in one task.
    Stream: ``dropDuplicatesWithinWatermark`` bounds the state (quirk Q8).
    Keys include the network: ids from different networks can collide. A row
    with a null in its key is no copy of another one: batch rows keep to
    their own delivery (topic coordinates), whichever key column is null.
    """
    keys = list(keys)
    if df.isStreaming:
        return df.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(keys)
    order_cols = [c for c in order if c in df.columns]
    keyed = [F.col(k).isNotNull() for k in keys]
    whole = keyed[0]
    for k in keyed[1:]:
        whole = whole & k
    alone = F.when(~whole, F.struct(*order_cols) if order_cols else F.monotonically_increasing_id())
    if not order_cols:
        return df.withColumn("_alone", alone).dropDuplicates([*keys, "_alone"]).drop("_alone")
    rest = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*rest), F.struct(*order_cols)).alias("_row")
    return df.groupBy(*keys, alone.alias("_alone")).agg(picked).select(*keys, "_row.*")


def unified_posts(bronze: DataFrame) -> DataFrame:
    """U2 + P15 + P16 + F24: the dashboard's one-schema view of all networks.

    Columns: source (label), post_id, text, author, created_at (as sent),
    engagement, likes, retweets, hashtags (comma string), subreddit, plus
    ``created_ts`` (parsed, UTC) for the time-based views. Unknown networks
    are skipped; missing values take the dashboard defaults.
    """
    src = F.col("source")
    m = F.from_json(_raw("metrics"), ALL_METRICS)
    is_tw, is_rd = src == "twitter", src == "reddit"
    likes = F.when(is_tw, m["likes"]).when(is_rd, m["score"]).otherwise(m["likes"])
    shares = F.when(is_tw, m["retweets"]).when(is_rd, F.lit(0)).otherwise(m["reposts"])
    reddit_text = F.concat(T.clean_html(F.coalesce(_raw("title"), F.lit(""))), F.lit(" "),
                           T.clean_html(F.coalesce(_raw("text"), F.lit(""))))
    text = (F.when(is_tw, F.coalesce(_raw("text"), F.lit("")))
            .when(is_rd, reddit_text)
            .otherwise(T.clean_plain(F.coalesce(_raw("text"), F.lit("")))))
    author = F.coalesce(F.when(is_tw, _raw("author_username")).when(is_rd, _raw("author"))
                        .otherwise(_raw("author_handle")), F.lit("Unknown"))
    created = F.when(is_rd, _raw("created_utc")).otherwise(_raw("created_at"))
    hashtags = F.when(is_rd, F.lit("")).otherwise(F.array_join(_arr("hashtags"), ","))
    out = bronze.where(M.source_label(src).isNotNull()).select(
        M.source_label(src).alias("source"), _raw("id").alias("post_id"), text.alias("text"),
        author.alias("author"), created.alias("created_at"),
        M.engagement(src, likes, shares).alias("engagement"),
        M.z(likes).alias("likes"), M.z(shares).alias("retweets"),
        hashtags.alias("hashtags"),
        F.when(is_rd, F.coalesce(_raw("subreddit"), F.lit(""))).alias("subreddit"),
        parse_time(created).alias("created_ts"),
        "processed_at", *_coords(bronze),
    )
    return out
