"""Streaming behaviour on hand-made files: late rows, bounded dedup, restart."""

import datetime as dt
import json

from pyspark.sql import functions as F

from plume.schemas import TOPIC_RECORD
from plume.session import scratch_path
from plume.sources.topic import read_topic_files
from plume.streaming import runner as RUN


def _post(i, minute, pid=None):
    t = dt.datetime(2025, 11, 11, 10, 0) + dt.timedelta(minutes=minute)
    data = {"id": str(pid or i), "text": "x", "created_at": t.isoformat() + "Z", "language": "en",
            "author_username": "u", "metrics": {"likes": 1, "retweets": 0, "replies": 0, "quotes": 0}}
    return (str(i).encode(), json.dumps({"source": "twitter", "timestamp": t.isoformat(), "data": data}).encode(),
            "t", 0, i, t)


def _land(spark, path, rows):
    spark.createDataFrame(rows, TOPIC_RECORD).coalesce(1).write.mode("append").parquet(path)


def _two_batches(spark, src):
    _land(spark, src, [_post(1, 0), _post(2, 5), _post(3, 95)])            # batch 1: watermark → 11:25
    _land(spark, src, [_post(4, 10), _post(5, 96, pid=3), _post(6, 100)])  # 10:10 is late; id 3 repeats
    return RUN.bronze_stream(read_topic_files(spark, src, streaming=True, max_files_per_trigger=1),
                             processed_at=F.col("topic_timestamp"))


def test_dedup_within_watermark(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    RUN.drain(RUN.start(RUN.silver_stream(_two_batches(spark, src)), ckpt, "parquet", out))
    got = sorted(r["post_id"] for r in spark.read.parquet(out).collect())
    assert got == ["1", "2", "3", "4", "6"]                                # the repeat of 3 is dropped


def test_window_aggregate_drops_late_rows(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    _land(spark, src, [_post(1, 0), _post(2, 5), _post(3, 95)])   # watermark → 11:25
    _land(spark, src, [_post(6, 100)])                             # windows ending ≤ 11:25 emitted
    _land(spark, src, [_post(4, 10)])                              # 10:10: its windows are gone
    stream = RUN.bronze_stream(read_topic_files(spark, src, streaming=True, max_files_per_trigger=1),
                               processed_at=F.col("topic_timestamp"))
    q = RUN.start(RUN.trending_stream(RUN.silver_stream(stream)), ckpt, "parquet", out)
    RUN.drain(q)
    rows = {r["window_start"].strftime("%H:%M"): r["post_count"] for r in spark.read.parquet(out).collect()}
    assert rows["09:30"] == 2 and rows["10:00"] == 2                # the late row is not counted (W5)
    assert RUN.dropped_late_rows(q) >= 1


def test_restart_reads_only_new_files(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))

    def run():
        s = RUN.bronze_stream(read_topic_files(spark, src, streaming=True), processed_at=F.col("topic_timestamp"))
        RUN.drain(RUN.start(s, ckpt, "parquet", out))
    _land(spark, src, [_post(1, 0), _post(2, 1)])
    run()
    _land(spark, src, [_post(3, 2)])
    run()
    run()
    assert spark.read.parquet(out).count() == 3


def test_batch_equals_stream_for_complete_counts(spark):
    from plume.operators import bronze as B
    from plume.operators import kpis as K

    src = scratch_path(spark, "src")
    _land(spark, src, [_post(i, i) for i in range(1, 8)])
    batch = K.count_by_source(B.bronze(read_topic_files(spark, src))).collect()
    name = "plume_parity_counts"
    agg = K.count_by_source(B.bronze(read_topic_files(spark, src, streaming=True)))
    RUN.drain(RUN.start(agg, scratch_path(spark, "ckpt"), "memory", mode="complete", query_name=name))
    assert sorted(map(tuple, batch)) == sorted(map(tuple, spark.table(name).collect()))


def test_submit_jobs_bronze_silver_gold(spark):
    import argparse

    from plume.streaming import jobs

    src, bronze, silver, gold = (scratch_path(spark, n) for n in ("src", "bronze", "silver", "gold"))
    _land(spark, src, [_post(1, 0), _post(2, 5), _post(3, 95), _post(4, 96, pid=3)]
          + [(b"x", b'{"bad', "t", 0, 99, dt.datetime(2025, 11, 11))])

    def run(job, **kw):
        args = argparse.Namespace(servers=None, topic="t", starting="earliest",
                                  checkpoint=scratch_path(spark, f"ckpt-{job}"),
                                  format="parquet", trigger="1 second", watermark="10 minutes",
                                  max_per_trigger=None, **kw)
        q = getattr(jobs, f"{job}_job")(spark, args)
        q.processAllAvailable()
        q.stop()
    run("bronze", input=src, out=bronze)
    assert spark.read.parquet(bronze).count() == 4
    assert spark.read.parquet(bronze + "_quarantine").count() == 1
    run("silver", input=bronze, out=silver)
    assert sorted(r["post_id"] for r in spark.read.parquet(silver).collect()) == ["1", "2", "3"]
    run("gold", input=silver, out=gold)
    assert spark.read.parquet(gold).count() >= 1


def test_intake_counts_per_batch(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "out", "ckpt"))
    bad = (b"x", b"{bad", "t", 0, 99, dt.datetime(2025, 11, 11))
    _land(spark, src, [_post(1, 0), _post(2, 5), _post(3, 95), bad])
    _land(spark, src, [_post(6, 100), bad, bad])
    _land(spark, src, [_post(4, 10)])                             # too late
    stream = RUN.bronze_stream(read_topic_files(spark, src, streaming=True, max_files_per_trigger=1),
                               processed_at=F.col("topic_timestamp"), observe="intake")
    q = RUN.start(RUN.trending_stream(RUN.silver_stream(stream)), ckpt, "parquet", out)
    RUN.drain(q)
    counted = [b for b in RUN.intake(q) if b["records"]]
    assert [(b["records"], b["parsed"], b["bad"], b["known_source"]) for b in counted] == [(4, 3, 1, 3), (3, 1, 2, 1), (1, 1, 0, 1)]
    assert sum(b["late"] for b in RUN.intake(q)) >= 1
