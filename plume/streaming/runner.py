"""Run any plume operator as a Structured Streaming query.

Operators are ``DataFrame -> DataFrame`` and contain no action, so the same
function serves a batch read and a ``readStream`` (W10). This module only
adds what streams need: a watermark, a sink, a trigger and a checkpoint in
the shared checkpoint folder (so a restarted driver, or a lost executor,
resumes from the committed offsets with no loss or repeat – W8).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import bronze as B
from ..operators import silver as S
from ..operators import trends as TR


def start(df: DataFrame, checkpoint: str, sink: str = "parquet", path: str | None = None,
          mode: str = "append", trigger: dict | None = None, partition_by=None,
          query_name: str | None = None, **options) -> StreamingQuery:
    """Start a streaming query. ``trigger`` as in ``DataStreamWriter.trigger``
    (default ``availableNow``: drain what is there, then stop – the "once"
    trigger of W7); ``processingTime='30 seconds'`` for a running job."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in options.items():
        w = w.option(k, v)
    w = w.trigger(**(trigger or {"availableNow": True}))
    w = w.format(sink)
    return w.start(path) if path else w.start()


def start_foreach_batch(df: DataFrame, checkpoint: str, fn: Callable[[DataFrame, int], None],
                        mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """One source read, any number of sinks: ``fn(batch_df, epoch_id)``
    persists the batch once and writes each sink from it."""
    return (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).foreachBatch(fn).start())


def drain(q: StreamingQuery) -> dict:
    """Wait for an ``availableNow`` query, however long it takes; return its last progress."""
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return q.lastProgress or {}


def dropped_late_rows(q: StreamingQuery) -> int:
    """Rows the stateful operators dropped as later than the watermark."""
    total = 0
    for p in q.recentProgress:
        for op in p.get("stateOperators", []):
            total += int(op.get("numRowsDroppedByWatermark", 0))
    return total


def intake(q: StreamingQuery, name: str = "intake") -> list[dict[str, int]]:
    """Per micro-batch, the records read, envelopes parsed, bad ones, posts of known networks, and rows that came
    too late; from the query's own progress, without another pass over the data. (Progress keeps the last 100 batches.)"""
    out = []
    for p in q.recentProgress:
        counts = p["observedMetrics"].get(name) if p.get("observedMetrics") else None
        if counts is not None:
            late = sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in p.get("stateOperators", []))
            row = {c: int(counts[c] or 0) for c in ("records", "parsed", "known_source")}
            out.append({"batch": int(p["batchId"]), **row, "bad": row["records"] - row["parsed"], "late": late})
    return out


# ---------------------------------------------------------------- stages
def bronze_stream(records: DataFrame, processed_at=None, observe: str | None = None) -> DataFrame:
    """Topic records → bronze rows (P1–P4), counted on the way if ``observe`` names the counts."""
    return B.bronze(records, processed_at=processed_at, observe=observe)


def silver_stream(bronze_df: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Bronze → silver for all networks with bounded dedup state (W4, Q8):
    the watermark goes on the event time before the dedup."""
    raw = S.silver_all(bronze_df, dedup=False)
    return raw.withWatermark("created_at", watermark).dropDuplicatesWithinWatermark(["source", "post_id"])


def trending_stream(silver_df: DataFrame, window: str = "1 hour", slide: str = "30 minutes") -> DataFrame:
    """The trend aggregate on a watermarked stream (append: a window is
    emitted once the watermark passes its end; later rows are dropped, W5)."""
    return TR.trending_windows(silver_df, window, slide)


def read_sink(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def counts_by_source_batch(batch: DataFrame) -> DataFrame:
    return batch.groupBy("source").agg(F.count(F.lit(1)).alias("post_count"))
