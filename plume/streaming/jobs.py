"""Long-running jobs, ready for ``spark-submit`` (the reference's entry points).

* ``bronze``   topic → bronze Parquet/Delta partitioned by (partition_date,
               source), micro-batch every 30 s; bad envelopes to a quarantine
               sink from the same read (W9).
* ``silver``   bronze files → typed, watermark-deduplicated silver posts.
* ``gold``     silver files → sliding-window trend scores (append, watermark).
* ``stats``    silver files by (partition_date, source) → hourly statistics,
               rewriting only the partitions that new files touch.

Example::

    spark-submit --py-files plume.zip submit_job.py bronze --servers broker:9092 \\
        --topic social-raw --out s3a://lake/bronze --checkpoint s3a://lake/_chk/bronze

The source is Kafka when ``--servers`` is given, else topic records stored as
Parquet under ``--input``. Checkpoints default to the folder named by
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_root, ensure_utc
from ..sources import topic as TP
from . import medallion as MED
from . import runner as RUN


def _records(spark: SparkSession, args) -> DataFrame:
    if args.servers:
        return TP.read_topic_stream(spark, args.servers, args.topic, starting=args.starting,
                                    max_offsets_per_trigger=args.max_per_trigger)
    return TP.read_topic_files(spark, args.input, streaming=True, max_files_per_trigger=args.max_per_trigger)


def bronze_job(spark: SparkSession, args):
    records = _records(spark, args)
    chk = args.checkpoint or f"{checkpoint_root(spark)}/bronze"

    def both(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            MED.write_bronze(batch, epoch_id, args.out, args.format)
        finally:
            batch.unpersist()
    # Both sinks overwrite their own epoch, so a replayed epoch stores nothing twice.
    return RUN.start_foreach_batch(records, chk, both, trigger={"processingTime": args.trigger})


def silver_job(spark: SparkSession, args):
    schema = spark.read.format(args.format).load(args.input).schema
    bronze_rows = spark.readStream.schema(schema).format(args.format).load(args.input)
    chk = args.checkpoint or f"{checkpoint_root(spark)}/silver"
    return RUN.start(RUN.silver_stream(bronze_rows, args.watermark), chk, args.format, args.out,
                     trigger={"processingTime": args.trigger})


def gold_job(spark: SparkSession, args):
    schema = spark.read.format(args.format).load(args.input).schema
    silver_rows = spark.readStream.schema(schema).format(args.format).load(args.input) \
        .withWatermark("created_at", args.watermark)
    chk = args.checkpoint or f"{checkpoint_root(spark)}/gold"
    gold = RUN.trending_stream(silver_rows)
    return RUN.start(gold, chk, args.format, args.out, trigger={"processingTime": args.trigger})


def stats_job(spark: SparkSession, args):
    chk = args.checkpoint or f"{checkpoint_root(spark)}/stats"
    return MED.incremental_gold(spark, args.input, args.out, chk, sentiment=None, trigger={"processingTime": args.trigger}, fmt=args.format)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="plume.streaming.jobs")
    ap.add_argument("job", choices=["bronze", "silver", "gold", "stats"])
    ap.add_argument("--servers")
    ap.add_argument("--topic", default="social-raw")
    ap.add_argument("--starting", default="latest")
    ap.add_argument("--input")
    ap.add_argument("--out", required=True)
    ap.add_argument("--checkpoint")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--trigger", default="30 seconds")
    ap.add_argument("--watermark", default="10 minutes")
    ap.add_argument("--max-per-trigger", dest="max_per_trigger", type=int)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"plume-{args.job}").getOrCreate()
    ensure_utc(spark)
    q = {"bronze": bronze_job, "silver": silver_job, "gold": gold_job, "stats": stats_job}[args.job](spark, args)
    q.awaitTermination()


if __name__ == "__main__":
    main()
