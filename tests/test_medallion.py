"""Stored silver and gold: nothing is lost, nothing twice, and gold follows silver."""

import argparse
import datetime as dt
import glob
import os

from plume.operators import silver as S
from plume.operators import trends as TR
from plume.session import scratch_path
from plume.streaming import jobs
from plume.streaming import medallion as MED
from plume.streaming import runner as RUN

from .test_streaming import _land, _post

T0 = dt.datetime(2025, 11, 11, 10)


def posts(spark, rows):
    """(source, post_id, hours from T0 or None, engagement)"""
    return spark.createDataFrame([(s, i, T0 + dt.timedelta(hours=h) if h is not None else None, e, "r", 0.5) for s, i, h, e in rows],
                                 "source string, post_id string, created_at timestamp, engagement_score bigint, community string, sentiment double")


def local(path):
    return path.removeprefix("file://")


def test_posts_without_id_or_time_are_quarantined(spark):
    path = scratch_path(spark, "silver")
    rows = [("a", "1", 0, 5), ("a", None, 0, 5), ("a", "", 1, 5), ("b", "2", None, 5), ("b", None, None, 5), ("b", "3", 30, 5)]
    MED.write_silver(posts(spark, rows), 7, path)
    stored, bad = spark.read.parquet(path), spark.read.parquet(path + "_quarantine")
    assert sorted(r["post_id"] for r in stored.collect()) == ["1", "3"]
    assert sorted(r["reason"] for r in bad.collect()) == ["no id", "no id", "no id", "no time"]
    assert stored.count() + bad.count() == len(rows)
    MED.write_silver(posts(spark, rows), 7, path)  # a replay of the epoch
    MED.write_silver(posts(spark, [("a", "9", 0, 1)]), 8, path)
    assert spark.read.parquet(path).count() == 3 and spark.read.parquet(path + "_quarantine").count() == 4


def test_posts_without_an_id_are_not_folded(spark):
    rows = [("r", None, 1, "a"), ("r", None, 2, "b"), ("r", "x", 3, "c"), ("r", "x", 4, "d"), (None, "x", 5, "e"), (None, "x", 6, "f")]
    df = spark.createDataFrame(rows, "source string, post_id string, topic_offset bigint, text string")
    assert sorted(r["text"] for r in S.dedup_posts(df).collect()) == ["a", "b", "c", "e", "f"]
    assert S.dedup_posts(df.drop("topic_offset")).count() == 5


def hourly(df):
    return sorted(map(tuple, df.select("hour", "source", "community", "post_count", "avg_sentiment", "total_engagement").collect()))


def test_gold_follows_silver_and_reads_new_files_only(spark):
    silver, gold, ckpt = (scratch_path(spark, n) for n in ("silver", "gold", "ckpt"))
    waves = [[("a", f"{k}", k % 50, k) for k in range(100)], [("a", "late", 3, 1000), ("b", "new", 400, 5)], [("b", "old", 26, 7)]]
    read, files = [], {}
    for n, wave in enumerate(waves):
        MED.write_silver(posts(spark, wave), n, silver)
        q = MED.incremental_gold(spark, silver, gold, ckpt)
        RUN.drain(q)
        read.append(sum(p["numInputRows"] for p in q.recentProgress))
        assert hourly(MED.read_gold(spark, gold)) == hourly(TR.hourly_stats(spark.read.parquet(silver), "sentiment"))
        now = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{local(gold)}/**/part-*.parquet", recursive=True)}
        files[n] = now
    assert read == [100, 2, 1]
    # The second wave touches two partitions, the third one other: the files of the rest stay as they are.
    assert {f.split("/")[-3] for f in set(files[0]) - set(files[1])} == {"partition_date=2025-11-11"}
    assert set(files[1]) <= set(files[2])
    q = MED.incremental_gold(spark, silver, gold, ckpt)
    RUN.drain(q)
    assert sum(p["numInputRows"] for p in q.recentProgress) == 0


def test_a_replayed_epoch_changes_nothing(spark):
    silver, gold, ckpt = (scratch_path(spark, n) for n in ("silver", "gold", "ckpt"))
    MED.write_silver(posts(spark, [("a", f"{k}", k, k) for k in range(60)]), 0, silver)
    RUN.drain(MED.incremental_gold(spark, silver, gold, ckpt))
    want = hourly(MED.read_gold(spark, gold))
    os.remove(f"{local(ckpt)}/commits/0")  # as if the driver had died before the commit
    for f in glob.glob(f"{local(ckpt)}/commits/.0*"):
        os.remove(f)
    RUN.drain(MED.incremental_gold(spark, silver, gold, ckpt))
    assert hourly(MED.read_gold(spark, gold)) == want


def test_gold_reads_touched_partitions_only(spark):
    path = scratch_path(spark, "silver")
    MED.write_silver(posts(spark, [("a", f"{k}", 24 * k, k) for k in range(20)]), 0, path)
    touched = spark.createDataFrame([(dt.date(2025, 11, 12), "a")], "partition_date date, source string")
    rows = MED.of_partitions(spark.read.parquet(path), touched)
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString() and rows.count() == 1


def test_bronze_job_is_exactly_once(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "bronze", "ckpt"))
    _land(spark, src, [_post(1, 0), _post(2, 5), (b"x", b"{bad", "t", 0, 99, T0)])

    def run():
        args = argparse.Namespace(servers=None, topic="t", starting="earliest", checkpoint=ckpt, format="parquet", trigger="1 second",
                                  watermark="10 minutes", max_per_trigger=None, input=src, out=out)
        q = jobs.bronze_job(spark, args)
        q.processAllAvailable()
        q.stop()

    run()
    for f in [f"{local(ckpt)}/commits/0", *glob.glob(f"{local(ckpt)}/commits/.0*")]:
        os.remove(f)
    run()  # the epoch is written again
    _land(spark, src, [_post(3, 9)])
    run()
    assert sorted(r["id"] for r in spark.read.parquet(out).selectExpr("raw_data['id'] AS id").collect()) == ["1", "2", "3"]
    assert spark.read.parquet(out + "_quarantine").count() == 1
