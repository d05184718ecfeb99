"""Cases that the test tables do not hold, for operators whose row could not turn red without them; and sinks and sources
that need a connector, as far as they go without one."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from plume.functions import text as T
from plume.operators import text as TX
from plume.operators import views as V
from plume.session import scratch_path
from plume.sources import sinks, topic
from plume.streaming import runner as RUN

AS_OF = "2024-01-30 12:00:00"


def test_posts_without_text_are_left_out_of_enriched_silver(spark):
    rows = [("1", "gpt news"), ("2", None), ("3", ""), ("4", " \t　 "), ("5", " ")]
    df = spark.createDataFrame([(i, t, ["A"]) for i, t in rows], "post_id string, text_clean string, hashtags array<string>")
    out = TX.enrich_posts(df).collect()
    assert [(r["post_id"], r["topics"]) for r in out] == [("1", ["gpt", "a"])]


def test_periods_leave_old_and_later_posts_out(spark):
    now = dt.datetime(2024, 1, 30, 12)
    rows = [(str(h), now - dt.timedelta(hours=h)) for h in (-30, -1, 0, 5, 6, 7, 11, 13, 35, 37, 167, 168, 169, 719, 720, 721)] + [("none", None)]
    df = spark.createDataFrame(rows, "id string, created_ts timestamp")
    dated = df.withColumn(V.DATE, F.to_date("created_ts"))
    ids = lambda d: {r["id"] for r in d.collect()}
    for frame in (df, dated):  # with and without partitions by date
        assert ids(V.filter_period(frame, "all", AS_OF)) == {r[0] for r in rows}
        assert ids(V.filter_period(frame, "today", AS_OF)) == {"-1", "0", "5", "6", "7", "11"}
        assert ids(V.filter_period(frame, "yesterday", AS_OF)) == {"13", "35"}
        assert ids(V.filter_period(frame, "week", AS_OF)) == {"-30", "-1", "0", "5", "6", "7", "11", "13", "35", "37", "167", "168"}
        assert ids(V.filter_period(frame, "month", AS_OF)) == {r[0] for r in rows} - {"721", "none"}
        assert ids(V.filter_last_hours(frame, 6, AS_OF)) == {"0", "5", "6"}
    with pytest.raises(ValueError):
        V.filter_period(df, "year", AS_OF)


def test_sentiment_of_all_three_labels(spark):
    df = spark.createDataFrame([(1, "Good good bad thing"), (2, "awful, terrible news"), (3, "plain words"), (4, None), (5, "")], "doc_id int, text string")
    out = {r["doc_id"]: (r["positive"], r["negative"], r["sentiment"], r["label"]) for r in TX.sentiment(
        df, pos=["good"], neg=["bad", "awful", "terrible"]).collect()}
    assert out[1] == (2, 1, 0.25, "positive") and out[2] == (0, 2, -0.6667, "negative") and out[3] == (0, 0, 0.0, "neutral")
    assert out[5][2:] == (0.0, "neutral")


def test_hashtags_are_counted_whatever_their_case_and_number(spark):
    df = spark.createDataFrame([(["AI", "ai", "ML"],), ([],), (None,), (["ml"],)], "hashtags array<string>")
    out = df.select(F.explode(F.transform("hashtags", lambda h: F.lower(h))).alias("h")).groupBy("h").count().collect()
    assert {r["h"]: r["count"] for r in out} == {"ai": 2, "ml": 2}


def test_links_and_percent_labels(spark):
    df = spark.createDataFrame([("reddit", "rust", "u", "a1", 12.345), ("twitter", None, "u", "2", 0.0), ("bluesky", None, "u.b", "3", 99.96), ("x", None, "u", "4", None)],
                               "s string, c string, a string, i string, p double")
    out = df.select(T.permalink("s", "c", "a", "i").alias("l"), T.percent1("p").alias("p")).collect()
    assert [r["l"] for r in out] == ["https://reddit.com/r/rust/comments/a1/", "https://twitter.com/u/status/2", "https://bsky.app/profile/u.b/post/3", None]
    assert [r["p"] for r in out][:3] == ["12.3%", "0.0%", "100.0%"]


def test_topic_rows_are_keyed_envelopes(spark):
    df = spark.createDataFrame([("7", "hello", "2024-01-01T00:00:00")], "id string, text string, at string")
    (row,) = sinks.to_topic_rows(df, "twitter", ["id", "text"], timestamp_col="at").collect()
    assert row["key"] == "7" and json.loads(row["value"]) == {"source": "twitter", "timestamp": "2024-01-01T00:00:00", "data": {"id": "7", "text": "hello"}}


def test_topic_sink_and_source_name_the_connector(spark):
    """Without the connector the call ends at its look-up, after all options were set."""
    rows = spark.createDataFrame([("1", "{}")], "key string, value string")
    for call in (lambda: sinks.write_topic(rows, "broker:9092", "t"), lambda: topic.read_topic_batch(spark, "broker:9092", "t"),
                 lambda: topic.read_topic_stream(spark, "broker:9092", "t", max_offsets_per_trigger=10)):
        with pytest.raises(Exception, match="(?i)kafka"):
            call()
    assert json.loads(topic.starting_offsets_json("t", {1: 5, 0: 7})) == {"t": {"0": 7, "1": 5}}


def test_lake_format_falls_back_and_console_sink_runs(spark, capfd):
    assert sinks.lake_format(spark) == "parquet"
    src = scratch_path(spark, "src")
    spark.createDataFrame([("shown on the console",)], "text string").write.format(sinks.lake_format(spark)).save(src)
    q = sinks.console(spark.readStream.schema("text string").parquet(src), rows=5)
    q.processAllAvailable()
    q.stop()
    assert q.lastProgress is not None and RUN.dropped_late_rows(q) == 0


def test_equal_versions_are_settled_the_same_way(spark):
    from plume.operators import lake

    rows = [("k", 5, v) for v in "abcdef"] + [("k", 4, "z"), ("l", 1, "y")]
    picks = {tuple(sorted((r["id"], r["v"]) for r in lake.latest_per_key(
        spark.createDataFrame(rows[n:] + rows[:n], "id string, version int, v string").repartition(1 + n % 3), ["id"], "version").collect()))
        for n in range(5)}
    assert len(picks) == 1 and dict(picks.pop())["k"] in "abcdef"


def test_ranks_are_cut_before_the_shuffle(spark):
    from plume.operators import ranking

    hours = [dt.datetime(2024, 1, 1, h) for h in range(3)]
    df = spark.createDataFrame([(f"t{k}", h, float(k % 4)) for h in hours for k in range(8)], "topic string, hour timestamp, trend_score double")
    whole, cut = ranking.topic_rank(df), ranking.topic_rank(df, limit=3)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.where("rank <= 3").collect())) and whole.count() == 24
    assert "WindowGroupLimit" in cut._jdf.queryExecution().sparkPlan().toString()
