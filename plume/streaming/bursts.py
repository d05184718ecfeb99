"""Bursts of a topic within a sliding hour (N3), on tables and on streams alike.

At every minute with a mention of a topic, the mentions of the 60 minutes that
end there are held against the hourly mean of the 24 hours before them. A burst
is on when there are ``minimum`` or more and they exceed ``threshold`` times
that mean; it gives one alert, at its first minute, and is over at the next
minute with a mention that is no burst, or after an hour without mentions.

The table version uses range windows over minute counts. The stream version
keeps, per topic, the minute counts of the last 25 hours as keyed state; a timer
at the end of the first open minute fires when the watermark passes it, and all
minutes that are complete by then are judged in order. State follows the clock,
not the number of posts, and checkpoints with the query: a restart repeats no
alert.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The processor travels with its code: the workers that run it, the driver's own one too, may lack this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOUR, LOOKBACK = 60, 24 * 60  # minutes
ALERT = "topic string, minute bigint, mentions bigint, baseline double"


def _mentions(posts: DataFrame, topics: str, ts: str) -> DataFrame:
    """(topic, minute), one row per post and topic; minutes since the epoch."""
    return posts.where(F.col(ts).isNotNull()).select(
        ts, F.explode(F.array_distinct(topics)).alias("topic"), F.floor(F.unix_seconds(ts) / 60).alias("minute"))


def _named(alerts: DataFrame) -> DataFrame:
    return alerts.select("topic", F.timestamp_seconds(F.col("minute") * 60).cast("timestamp_ntz").alias("minute"), "mentions",
                         F.round("baseline", 4).alias("baseline"))


def burst_alerts(posts: DataFrame, threshold: float = 2.0, minimum: int = 5, topics: str = "topics", ts: str = "created_at") -> DataFrame:
    """(topic, minute, mentions, baseline): one row per burst of a table of posts. The windows of a topic run over its
    minutes, however many posts a minute has."""
    counts = _mentions(posts, topics, ts).groupBy("topic", "minute").agg(F.count(F.lit(1)).alias("n"))
    per = Window.partitionBy("topic").orderBy("minute")
    judged = counts.select(
        "topic", "minute", F.sum("n").over(per.rangeBetween(1 - HOUR, 0)).alias("mentions"),
        (F.coalesce(F.sum("n").over(per.rangeBetween(1 - HOUR - LOOKBACK, -HOUR)), F.lit(0)) * HOUR / LOOKBACK).alias("baseline"))
    judged = judged.withColumn("on", (F.col("mentions") >= minimum) & (F.col("mentions") > threshold * F.col("baseline")))
    going = F.lag("on", 1, False).over(per) & (F.col("minute") - F.lag("minute").over(per) < HOUR)
    return _named(judged.withColumn("going", F.coalesce(going, F.lit(False))).where("on AND NOT going"))


class BurstProcessor(StatefulProcessor):
    """Minute counts and the last judgement of one topic."""

    def __init__(self, threshold: float, minimum: int) -> None:
        self.threshold, self.minimum = threshold, minimum

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Minutes with their counts, by minute; the first open one; the last judged one and whether it was a burst.
        self.state = handle.getValueState("minutes", "minute array<bigint>, n array<bigint>, open bigint, last bigint, burst boolean")

    def _read(self) -> tuple[np.ndarray, np.ndarray, int, int, bool]:
        if not self.state.exists():
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0, -HOUR, False
        minute, n, first, last, burst = self.state.get()
        return np.array(minute, np.int64), np.array(n, np.int64), first, last, burst

    def _wait(self, minute: np.ndarray, first: int) -> None:
        """One timer, at the end of the first open minute."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        waiting = minute[minute >= first]
        if len(waiting):
            self.handle.registerTimer(int(waiting[0] + 1) * 60_000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        minute, n, first, last, burst = self._read()
        more = np.concatenate([frame["minute"].to_numpy(np.int64) for frame in rows])
        every, place = np.unique(np.concatenate([minute, more]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([n, np.ones(len(more))])).astype(np.int64)
        self.state.update((every.tolist(), counts.tolist(), int(first), int(last), bool(burst)))
        self._wait(every, first)
        return iter(())  # alerts wait for the watermark

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        minute, n, first, last, burst = self._read()
        until = timerValues.getCurrentWatermarkInMs() // 60_000  # minutes before this one are complete
        total = np.concatenate([[0], np.cumsum(n)])
        out = []
        for i in range(int(np.searchsorted(minute, first)), int(np.searchsorted(minute, until))):
            at = int(minute[i])
            before = np.searchsorted(minute, [at + 1 - HOUR - LOOKBACK, at + 1 - HOUR])
            mentions, baseline = int(total[i + 1] - total[before[1]]), float(total[before[1]] - total[before[0]]) * HOUR / LOOKBACK
            on = mentions >= self.minimum and mentions > self.threshold * baseline
            if on and not (burst and at - last < HOUR):
                out.append((key[0], at, mentions, baseline))
            last, burst = at, on
        first = max(first, until)
        keep = minute > min(first, last + 1) - HOUR - LOOKBACK
        if keep.any():
            self.state.update((minute[keep].tolist(), n[keep].tolist(), int(first), int(last), bool(burst)))
            self._wait(minute[keep], first)
        else:
            self.state.clear()
        if out:
            yield pd.DataFrame(out, columns=["topic", "minute", "mentions", "baseline"]).astype({"topic": object})

    def close(self) -> None:
        pass


def burst_alert_stream(posts: DataFrame, threshold: float = 2.0, minimum: int = 5, topics: str = "topics", ts: str = "created_at") -> DataFrame:
    """As :func:`burst_alerts`, on a stream of posts with a watermark on ``ts``; alerts of minutes that the watermark has
    passed. Append mode; start it within :func:`keyed_state`."""
    keyed = _mentions(posts, topics, ts).groupBy("topic")
    return _named(keyed.transformWithStateInPandas(BurstProcessor(threshold, minimum), ALERT, "Append", "EventTime"))


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start meanwhile keep their state in RocksDB, which timers need, whatever the session's own store is:
    a stream holds on to the settings that it started with."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
