"""Sinks (S6, S9, S10, S11). Format-agnostic: the same call writes Parquet
here and Kafka/Delta on a cluster that has those connectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .envelope import envelope_json


def to_topic_rows(df: DataFrame, source: str, data_cols, key_col: str = "id",
                  timestamp_col: str | None = None) -> DataFrame:
    """One envelope per row, keyed by post id (same key → same topic
    partition → per-post order)."""
    data = F.struct(*[F.col(c) for c in data_cols])
    ts = F.col(timestamp_col).cast("string") if timestamp_col else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return df.select(F.col(key_col).cast("string").alias("key"),
                     envelope_json(F.lit(source), data, ts).alias("value"))


def write_topic(df: DataFrame, servers: str, topic: str, acks: str = "all",
                compression: str = "gzip", streaming_checkpoint: str | None = None):
    """Keyed topic sink, acks=all, gzip (producer options pass through)."""
    w = df.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
    opts = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": acks,
            "kafka.compression.type": compression}
    if df.isStreaming:
        ws = w.writeStream.format("kafka").option("checkpointLocation", streaming_checkpoint)
        for k, v in opts.items():
            ws = ws.option(k, v)
        return ws.start()
    wb = w.write.format("kafka")
    for k, v in opts.items():
        wb = wb.option(k, v)
    wb.save()
    return None


def lake_format(spark, preferred: str = "delta") -> str:
    """``delta`` when its classes are on the classpath, else ``parquet``."""
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("io.delta.sql.DeltaSparkSessionExtension")
        return preferred
    except Exception:  # noqa: BLE001 - absent connector
        return "parquet"


def console(df: DataFrame, rows: int = 20, truncate: bool = False, mode: str = "append"):
    """Console sink with a row cap / no truncation (debugging only)."""
    return (df.writeStream.format("console").outputMode(mode).option("numRows", rows)
            .option("truncate", str(truncate).lower()).start())
