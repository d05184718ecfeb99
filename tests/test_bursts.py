"""Sliding-hour bursts (N3): table and stream against plain Python, restart without repeats."""

import datetime as dt
import random

import pytest

from plume.session import scratch_path
from plume.streaming import bursts as BU
from plume.streaming import runner as RUN

T0 = dt.datetime(2025, 11, 1)
SCHEMA = "post_id string, created_at timestamp, topics array<string>"


def plain(rows, threshold, minimum, until=None):
    by = {}
    for _, t, topics in rows:
        for topic in set(topics or []):
            m = int((t - dt.datetime(1970, 1, 1)).total_seconds()) // 60
            by.setdefault(topic, {}).setdefault(m, 0)
            by[topic][m] += 1
    out = []
    for topic, counts in by.items():
        last, on = None, False
        for m in sorted(counts):
            hour = sum(n for k, n in counts.items() if m - 60 < k <= m)
            base = sum(n for k, n in counts.items() if m - 1500 < k <= m - 60) / 24
            burst = hour >= minimum and hour > threshold * base
            if burst and not (on and m - last < 60) and (until is None or m < until):
                out.append((topic, dt.datetime(1970, 1, 1) + dt.timedelta(minutes=m), hour, round(base, 4)))
            last, on = m, burst
    return sorted(out)


def posts(seed=1, days=4):
    """A steady topic with bursts on two days, one of them with a gap of an hour inside, and a rare topic."""
    rng = random.Random(seed)
    rows = []
    for k in range(days * 24 * 6):
        rows.append((T0 + dt.timedelta(minutes=10 * k, seconds=rng.randrange(600)), ["a"] if k % 3 else ["a", "b"]))
    for start, n in ((30 * 60, 40), (32 * 60, 25), (70 * 60, 60), (75 * 60, 30)):
        rows += [(T0 + dt.timedelta(minutes=start + rng.randrange(30), seconds=rng.randrange(60)), ["a"]) for _ in range(n)]
    rows.sort(key=lambda r: r[0])
    return [(str(i), t, topics) for i, (t, topics) in enumerate(rows)]


def alerts(df):
    return sorted((r["topic"], r["minute"], r["mentions"], r["baseline"]) for r in df.collect())


@pytest.mark.parametrize("threshold, minimum", [(2.0, 5), (1.2, 3), (5.0, 1)])
def test_table(spark, threshold, minimum):
    rows = posts()
    got = alerts(BU.burst_alerts(spark.createDataFrame([*rows, ("n", None, ["a"]), ("m", T0, None)], SCHEMA), threshold, minimum))
    assert got == plain(rows, threshold, minimum) and len(got) >= 3


def land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_table_and_a_restart_repeats_no_alert(spark):
    rows = posts(2)
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "alerts", "ckpt"))

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src).withWatermark("created_at", "10 minutes")
        RUN.drain(RUN.start(BU.burst_alert_stream(stream, 2.0, 5), ckpt, "parquet", out))

    cuts = [0, len(rows) // 3, len(rows) // 2, len(rows)]
    for low, high in zip(cuts, cuts[1:]):  # a restart between the files, in the midst of bursts
        land(spark, src, rows[low:high])
        run()
    run()
    end = rows[-1][1] - dt.timedelta(minutes=10)
    until = int((end - dt.datetime(1970, 1, 1)).total_seconds()) // 60
    got = alerts(spark.read.parquet(out))
    assert got == plain(rows, 2.0, 5, until) and len(got) >= 3
    late = [("late", T0 + dt.timedelta(hours=30, minutes=k % 5), ["a"]) for k in range(500)]  # behind the watermark
    land(spark, src, late)
    run()
    assert alerts(spark.read.parquet(out)) == got


def test_state_follows_the_clock_not_the_posts():
    class Handle:
        def __init__(self):
            self.timers = []

        def getValueState(self, name, schema):
            class Value:
                held = None
                exists = lambda self: self.held is not None
                get = lambda self: self.held

                def update(self, value):
                    self.held = value

                def clear(self):
                    self.held = None
            return Value()

        def listTimers(self):
            return list(self.timers)

        def deleteTimer(self, t):
            self.timers.remove(t)

        def registerTimer(self, t):
            self.timers.append(t)

    class Clock:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    import pandas as pd

    processor = BU.BurstProcessor(2.0, 5)
    handle = Handle()
    processor.init(handle)
    most = 0
    for hour in range(400):
        minutes = [hour * 60 + m for m in range(60) for _ in range(20)]
        list(processor.handleInputRows(("a",), iter([pd.DataFrame({"minute": minutes})]), Clock(0)))
        assert len(handle.timers) == 1
        list(processor.handleExpiredTimer(("a",), Clock((hour * 60 + 50) * 60_000), None))
        most = max(most, len(processor.state.held[0]))
    assert most <= 26 * 60


def test_no_posts(spark):
    assert BU.burst_alerts(spark.createDataFrame([], SCHEMA)).collect() == []


def test_the_processor_travels_with_its_code(tmp_path):
    """Workers that lack the package can load it, the driver's own worker too."""
    import os
    import subprocess
    import sys

    import pyspark
    from pyspark import cloudpickle

    (tmp_path / "processor").write_bytes(cloudpickle.dumps(BU.BurstProcessor(2.0, 5)))
    code = ("import sys, pickle; assert 'plume' not in sys.modules; p = pickle.load(open('processor', 'rb'));"
            "assert 'plume' not in sys.modules; print(p.threshold, p.minimum)")
    where = os.path.dirname(os.path.dirname(pyspark.__file__))
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": where}, capture_output=True, text=True)
    assert done.stdout.split() == ["2.0", "5"], done.stderr


def test_keyed_state_is_kept_in_rocksdb_whatever_the_session_uses(spark):
    """And the session's own setting is back once the stream has begun."""
    key, own = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(key)
    spark.conf.set(key, own)
    try:
        rows = posts(3)
        src, out = scratch_path(spark, "src"), scratch_path(spark, "alerts")
        land(spark, src, rows)
        stream = spark.readStream.schema(SCHEMA).parquet(src).withWatermark("created_at", "10 minutes")
        with BU.keyed_state(spark):
            q = RUN.start(BU.burst_alert_stream(stream, 2.0, 5), scratch_path(spark, "ckpt"), "parquet", out)
        assert spark.conf.get(key) == own
        RUN.drain(q)
        until = int((rows[-1][1] - dt.timedelta(minutes=10) - dt.datetime(1970, 1, 1)).total_seconds()) // 60
        got = alerts(spark.read.parquet(out))
        assert got == plain(rows, 2.0, 5, until) and len(got) >= 3
    finally:
        spark.conf.set(key, before)
