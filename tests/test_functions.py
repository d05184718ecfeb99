"""Hand-made rows, one quirk each (FIXTURES.md, SURVEY §1.4)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from plume.functions import text as T
from plume.functions.time import age_bucket, day_label, parse_time
from plume.operators import bronze as B
from plume.operators import silver as S


def one(spark, col, value=None, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def envelopes(spark, payloads):
    rows = [(None if p is None else p.encode(), i % 3, i, dt.datetime(2025, 11, 11)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "value binary, partition int, offset bigint, timestamp timestamp")


def env(source, data, ts="2025-11-11T00:00:00Z"):
    return json.dumps({"source": source, "timestamp": ts, "data": data})


def test_twitter_clean_removes_url_mention_and_hash(spark):
    # Q11: URL, www., @mention and the '#' character go; blanks stay
    assert one(spark, T.clean_twitter(F.col("x")), "Hi #AI @bob http://x.y www.a.b ok") == "hi ai    ok"


def test_reddit_clean_keeps_mentions(spark):
    assert one(spark, T.clean_reddit(F.col("x")), "See @bob http://x.y") == "see @bob "


def test_html_unescape_before_strip(spark):
    # Q12: unescape first, so an escaped tag is stripped too; &amp; decodes once
    assert one(spark, T.clean_html(F.col("x")), "<p>a</p>  b &lt;i&gt;c") == "a b c"
    assert one(spark, T.clean_html(F.col("x")), "Tom &amp; Jerry") == "Tom & Jerry"
    assert one(spark, T.html_unescape(F.col("x")), "&amp;lt;") == "&lt;"


def test_full_unescape_udf_matches_python(spark):
    import html
    s = "caf&eacute; &#233; &lt;b&gt; &amp;amp;"
    assert one(spark, T.html_unescape(F.col("x"), full=True), s) == html.unescape(s)


def test_tags_and_mentions(spark):
    row = spark.createDataFrame([("Hi #AI and #ml_2 @bob @name.bsky.social",)], "x string")
    r = row.select(T.extract_hashtags("x").alias("h"), T.extract_mentions("x").alias("m")).first()
    assert r["h"] == ["AI", "ml_2"] and r["m"] == ["bob", "name.bsky.social"]


def test_parse_time_formats(spark):
    # Q15/Q25/Q30: Z, +08:00, no offset, epoch number and epoch string; junk → NULL
    df = spark.createDataFrame([("2025-11-11T00:00:00Z",), ("2025-11-11T08:00:00+08:00",),
                                ("2025-11-11T00:00:00",), ("1762819200",), ("nope",), (None,)], "x string")
    got = [r["t"] for r in df.select(parse_time("x").cast("timestamp_ntz").alias("t")).collect()]
    want = dt.datetime(2025, 11, 11)
    assert got[:4] == [want] * 4 and got[4:] == [None, None]


def test_age_bucket_clamps_future(spark):
    # Q33: a future time reads "just now"; thresholds as the dashboard
    now = "2025-11-11 12:00:00"
    cases = {"2025-11-12 00:00:00": "just now", "2025-11-11 11:59:30": "just now",
             "2025-11-11 11:30:00": "30 minutes ago", "2025-11-11 09:00:00": "3 hours ago",
             "2025-11-08 12:00:00": "3 days ago", "2025-09-01 12:00:00": "2 months ago",
             "2023-11-01 12:00:00": "2 years ago"}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = {r["x"]: r["a"] for r in df.select("x", age_bucket(F.col("x").cast("timestamp"), now).alias("a")).collect()}
    assert got == cases


def test_day_label(spark):
    now = "2025-11-11 12:00:00"
    cases = {"2025-11-11": "today", "2025-11-10": "yesterday", "2025-11-05": "6 days ago",
             "2025-10-01": "2025-10-01", "2025-11-20": "today"}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = {r["x"]: r["l"] for r in df.select("x", day_label(F.col("x").cast("date"), now).alias("l")).collect()}
    assert got == cases


def test_bad_envelopes_are_quarantined_not_bronze(spark):
    # Q32: malformed JSON, a non-object and NULL never reach bronze
    recs = envelopes(spark, ['{"bad', "[]", None, env("twitter", {"id": "1", "text": "ok"})])
    assert B.bronze(recs).count() == 1
    bad = B.split_bad(recs).select("error").collect()
    assert len(bad) == 3


def test_silver_quirks(spark):
    tw = {"id": "1", "text": "Hi #AI", "created_at": "2025-11-11T00:00:00+00:00", "author_username": "a",
          "language": "en", "metrics": {"likes": 1, "retweets": 1, "replies": None, "quotes": 1},
          "hashtags": ["AI"], "mentions": None}
    fr = dict(tw, id="2", language="fr")
    rd = {"id": "1", "title": "Tom &amp; Jerry", "text": "t", "created_utc": "2025-11-11T00:00:00",
          "author": "[deleted]", "subreddit": "ml", "metrics": {"score": 5, "upvote_ratio": 0.97, "num_comments": 2}}
    bs = {"id": "1", "uri": "at://x/app.bsky.feed.post/1", "text": "yo", "created_at": "2025-11-11T00:00:00Z",
          "author_handle": "h.bsky.social", "metrics": {"likes": 2, "reposts": 1}}
    recs = envelopes(spark, [env("twitter", tw), env("twitter", fr), env("twitter", tw), env("reddit", rd),
                             env("bluesky", bs), env("hackernews", {"id": "9"})])
    b = B.bronze(recs)
    s = {(r["source"], r["post_id"]): r for r in S.silver_all(b).collect()}
    # dedup on (source, id): ids equal across networks survive (Q8); fr filtered
    assert sorted(s) == [("bluesky", "1"), ("reddit", "1"), ("twitter", "1")]
    # Q9: NULL replies counts 0; 2·1 + 5·1 + 3·0 + 4·1
    assert s[("twitter", "1")]["engagement_score"] == 11
    assert s[("twitter", "1")]["num_mentions"] == 0          # Q31
    assert s[("reddit", "1")]["engagement_score"] == 5 + 2 * 2
    assert s[("bluesky", "1")]["language"] == "en"          # F31 default
    m = S.silver_reddit(b).select(F.from_json(F.col("text"), "x int").alias("_")).count()
    assert m == 1
    # strict mode propagates NULL metrics instead
    strict = {(r["source"], r["post_id"]): r for r in S.silver_all(b, strict=True).collect()}
    assert strict[("twitter", "1")]["engagement_score"] is None


def test_upvote_ratio_is_fractional(spark):
    # Q4: declared int in the reference read schema (NULL), double here
    rd = {"id": "1", "metrics": {"score": 1, "upvote_ratio": 0.97, "num_comments": 0}}
    b = B.bronze(envelopes(spark, [env("reddit", rd)]))
    r = b.select(F.from_json(F.col("raw_data")["metrics"], "score bigint, upvote_ratio double").alias("m")).first()
    assert r["m"]["upvote_ratio"] == 0.97


def test_unified_posts_defaults(spark):
    rd = {"id": "1", "title": "Tom &amp; Jerry", "text": "<p>a</p>  b &lt;i&gt;c", "created_utc": "2025-11-11T00:00:00",
          "metrics": {"score": 3}}
    u = S.unified_posts(B.bronze(envelopes(spark, [env("reddit", rd), env("hackernews", {"id": "2"})]))).collect()
    assert len(u) == 1
    r = u[0]
    assert (r["source"], r["text"], r["author"], r["engagement"], r["subreddit"]) == \
        ("Reddit", "Tom & Jerry a b c", "Unknown", 3, "")
