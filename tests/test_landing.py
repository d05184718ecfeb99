"""A topic lands in as many files as its size needs, and every time slice is still one micro-batch."""

import datetime as dt

from plume.plans import catalog
from plume.session import scratch_path
from plume.sources import testbed
from plume.sources import topic as TP
from plume.schemas import TOPIC_RECORD

T0 = dt.datetime(2024, 1, 1)


def records(spark):
    """400 records on the first day, one twelve days later, 50 after 24 days."""
    days = [0] * 400 + [12] + [24] * 50
    rows = [(str(i).encode(), b"x" * 100, "t", i % 3, i, T0 + dt.timedelta(days=d, seconds=i)) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, TOPIC_RECORD)


def test_files_follow_the_largest_slice(spark, monkeypatch):
    assert testbed.files_per_slice(records(spark)) == 2
    monkeypatch.setattr(testbed, "FILE_BYTES", 8_000)
    assert testbed.files_per_slice(records(spark)) == 5
    assert testbed.files_per_slice(records(spark).limit(0)) == 2


def test_every_micro_batch_is_one_slice(spark, monkeypatch):
    monkeypatch.setattr(testbed, "FILE_BYTES", 8_000)
    at = catalog._landed(records(spark), "landed")
    assert at.files == 5 and len(spark.read.parquet(at.path).inputFiles()) == 15
    sizes = []
    q = catalog._topic_stream(spark, at).writeStream.foreachBatch(lambda b, i: sizes.append(b.count())) \
        .option("checkpointLocation", scratch_path(spark, "ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sizes == [400, 1, 50]
    assert TP.read_topic_files(spark, at.path).count() == 451


def test_rows_are_dealt_out_for_parsing(spark):
    out = catalog.dealt_out(spark.range(1000).coalesce(1), 10)
    assert out.rdd.getNumPartitions() >= 100 and out.count() == 1000
