"""All schemas in one place: topic record, envelope, per-network posts, layers."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DateType, DoubleType, IntegerType,
    LongType, MapType, StringType, StructField, StructType, TimestampType,
)

# The message-topic record as every topic reader (Kafka or file) exposes it.
TOPIC_RECORD = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
])

# Envelope as bronze reads it: nested values of ``data`` stay JSON text.
ENVELOPE_MAP = StructType([
    StructField("source", StringType()),
    StructField("timestamp", StringType()),
    StructField("data", MapType(StringType(), StringType())),
])

TWITTER_METRICS = StructType([
    StructField("likes", LongType()),
    StructField("retweets", LongType()),
    StructField("replies", LongType()),
    StructField("quotes", LongType()),
])

TWITTER_POST = StructType([
    StructField("id", StringType()),
    StructField("text", StringType()),
    StructField("created_at", StringType()),
    StructField("author_id", StringType()),
    StructField("author_username", StringType()),
    StructField("author_name", StringType()),
    StructField("author_verified", BooleanType()),
    StructField("language", StringType()),
    StructField("metrics", TWITTER_METRICS),
    StructField("hashtags", ArrayType(StringType())),
    StructField("mentions", ArrayType(StringType())),
])

# upvote_ratio is a fraction: double, not int (quirk Q4).
REDDIT_METRICS = StructType([
    StructField("score", LongType()),
    StructField("upvote_ratio", DoubleType()),
    StructField("num_comments", LongType()),
])

REDDIT_POST = StructType([
    StructField("id", StringType()),
    StructField("title", StringType()),
    StructField("text", StringType()),
    StructField("created_utc", StringType()),
    StructField("author", StringType()),
    StructField("subreddit", StringType()),
    StructField("url", StringType()),
    StructField("permalink", StringType()),
    StructField("metrics", REDDIT_METRICS),
    StructField("is_self", BooleanType()),
    StructField("flair", StringType()),
    StructField("domain", StringType()),
    StructField("gilded", LongType()),
    StructField("stickied", BooleanType()),
])

BLUESKY_METRICS = StructType([
    StructField("likes", LongType()),
    StructField("reposts", LongType()),
    StructField("replies", LongType()),
    StructField("quotes", LongType()),
])

BLUESKY_POST = StructType([
    StructField("id", StringType()),
    StructField("uri", StringType()),
    StructField("text", StringType()),
    StructField("created_at", StringType()),
    StructField("author_did", StringType()),
    StructField("author_handle", StringType()),
    StructField("author_display_name", StringType()),
    StructField("language", StringType()),
    StructField("metrics", BLUESKY_METRICS),
    StructField("hashtags", ArrayType(StringType())),
    StructField("mentions", ArrayType(StringType())),
])

POST_SCHEMAS = {"twitter": TWITTER_POST, "reddit": REDDIT_POST, "bluesky": BLUESKY_POST}

BRONZE = StructType([
    StructField("source", StringType()),
    StructField("event_timestamp", StringType()),
    StructField("raw_data", MapType(StringType(), StringType())),
    StructField("processed_at", TimestampType()),
    StructField("partition_date", DateType()),
    StructField("topic_partition", IntegerType()),
    StructField("topic_offset", LongType()),
])

SILVER = StructType([
    StructField("source", StringType()),
    StructField("post_id", StringType()),
    StructField("text", StringType()),
    StructField("text_clean", StringType()),
    StructField("author", StringType()),
    StructField("author_id", StringType()),
    StructField("created_at", TimestampType()),
    StructField("language", StringType()),
    StructField("community", StringType()),
    StructField("likes", LongType()),
    StructField("shares", LongType()),
    StructField("replies", LongType()),
    StructField("quotes", LongType()),
    StructField("engagement_score", LongType()),
    StructField("engagement", LongType()),
    StructField("hashtags", ArrayType(StringType())),
    StructField("mentions", ArrayType(StringType())),
    StructField("num_hashtags", LongType()),
    StructField("num_mentions", LongType()),
    StructField("processed_at", TimestampType()),
    StructField("topic_partition", IntegerType()),
    StructField("topic_offset", LongType()),
])

QUARANTINE = StructType([
    StructField("payload", StringType()),
    StructField("error", StringType()),
    StructField("quarantined_at", TimestampType()),
])
