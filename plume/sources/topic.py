"""Message-topic scans (S1–S4, S15) over any reader that yields topic records.

With the Kafka connector on the classpath these read the broker; without it
(as in tests) the same functions run over topic records kept as Parquet.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import TOPIC_RECORD


def read_topic_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                      fail_on_data_loss: bool = False, max_offsets_per_trigger: int | None = None,
                      **options) -> DataFrame:
    """Unbounded topic scan (Kafka source)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def read_topic_batch(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                     ending: str = "latest", **options) -> DataFrame:
    """Bounded scan from a start position to the current end."""
    r = (spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting).option("endingOffsets", ending))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def read_topic_files(spark: SparkSession, path: str, streaming: bool = False,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Topic records stored as Parquet (file stand-in for the broker)."""
    if not streaming:
        return spark.read.schema(TOPIC_RECORD).parquet(path)
    r = spark.readStream.schema(TOPIC_RECORD)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def starting_offsets_json(topic: str, positions: dict[int, int]) -> str:
    """``startingOffsets`` JSON for a replay from stored positions."""
    return json.dumps({topic: {str(p): int(o) for p, o in sorted(positions.items())}})


def replay_from(records: DataFrame, positions: dict[int, int]) -> DataFrame:
    """S15 on stored records: rows at or after the position of their partition;
    partitions without a position are read from the start."""
    cond = None
    for p, o in positions.items():
        c = (F.col("partition") == p) & (F.col("offset") >= o)
        cond = c if cond is None else cond | c
    listed = F.col("partition").isin(list(positions))
    return records.where(cond | ~listed) if cond is not None else records


def tail(records: DataFrame, n: int = 50) -> DataFrame:
    """S3/Q14: a true global tail – the last n of every partition (by offset),
    then the last n of those by record time. The per-partition cut is a
    ``row_number() <= n`` (map-side group limit), the global one a top-n."""
    w = Window.partitionBy("partition").orderBy(F.desc("offset"))
    per_part = records.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
    return per_part.orderBy(F.desc("timestamp"), F.desc("offset"), F.asc("partition")).limit(n)


def end_offsets(records: DataFrame) -> DataFrame:
    """Partitions, sum of end offsets (what a broker reports, which
    includes expired messages) and the real number of stored messages."""
    per = records.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"),
                                           F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("partitions"),
                   F.sum("end_offset").alias("end_offset_total"),
                   F.sum("n").alias("message_count"))
