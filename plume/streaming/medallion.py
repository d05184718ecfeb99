"""Silver and gold as stored tables that are kept up to date.

Every write of a micro-batch names its epoch, as the last partition folder or
by overwriting what it replaces, so a replayed epoch writes the same rows to
the same place again and nothing is stored twice.

* **Bronze** rows by (partition_date, source, epoch).
* **Silver** posts by (partition_date, source, epoch), the date of the post.
  Posts without an id or a time have no place there; they are quarantined with
  the reason, none is lost.
* **Gold** hourly statistics by (partition_date, source). A micro-batch of new
  silver files names the (date, network) partitions that it touches; only those
  are read again and rewritten. The stream itself reads each file once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import bronze as B
from ..operators import trends as TR
from ..session import Workspace
from . import runner as RUN

PLACE = ["partition_date", "source"]


def overwrite_touched(df: DataFrame, path: str, partition_cols, fmt: str = "parquet") -> None:
    """Replace only the partitions that ``df`` holds rows of. Rows are clustered by partition first, and adaptive
    execution splits a partition that holds a third of all rows."""
    df.hint("rebalance", *partition_cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .format(fmt).partitionBy(*partition_cols).save(path)


def write_bronze(batch: DataFrame, epoch_id: int, path: str, fmt: str = "parquet") -> None:
    """One epoch of topic records: parsed envelopes, and the bad ones to ``<path>_quarantine``."""
    epoch = F.lit(epoch_id).cast("bigint")
    overwrite_touched(B.bronze(batch, processed_at=_arrival(batch)).withColumn("epoch", epoch), path, [*PLACE, "epoch"], fmt)
    overwrite_touched(B.split_bad(batch, processed_at=_arrival(batch)).withColumn("epoch", epoch), f"{path}_quarantine", ["epoch"], fmt)


def _arrival(batch: DataFrame):
    """The topic's own stamp where there is one: a replay after midnight then goes to the same date."""
    return F.col("topic_timestamp") if "timestamp" in batch.columns else None


def placed(posts: DataFrame) -> DataFrame:
    """Adds the date that a post is stored under, and why it can't be stored (null where it can)."""
    reason = F.when(F.coalesce(F.col("post_id"), F.lit("")) == "", "no id").when(F.col("created_at").isNull(), "no time")
    return posts.withColumn("partition_date", F.to_date("created_at")).withColumn("reason", reason)


def write_silver(posts: DataFrame, epoch_id: int, path: str, fmt: str = "parquet") -> None:
    """One epoch of silver posts; those without an id or a time to ``<path>_quarantine`` with the reason."""
    every = placed(posts).withColumn("epoch", F.lit(epoch_id).cast("bigint"))
    overwrite_touched(every.where("reason IS NULL").drop("reason"), path, [*PLACE, "epoch"], fmt)
    overwrite_touched(every.where("reason IS NOT NULL").drop("partition_date"), f"{path}_quarantine", ["epoch"], fmt)


def of_partitions(silver: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of the touched partitions: one row a date and network is broadcast, and prunes the scan. The optimiser prunes
    by a side only if that side has a condition of its own."""
    dated = touched.where(F.col("partition_date") >= F.lit("0001-01-01").cast("date"))
    return silver.join(F.broadcast(dated), PLACE, "left_semi")


def refresh_gold(silver: DataFrame, touched: DataFrame, path: str, sentiment: str | None = "sentiment", fmt: str = "parquet") -> None:
    """Recompute the hourly statistics of the touched (partition_date, source) partitions and replace them. The semi-join
    prunes silver's partitions at run time."""
    stats = TR.hourly_stats(of_partitions(silver, touched), sentiment)
    overwrite_touched(stats.withColumn("partition_date", F.to_date("hour")), path, PLACE, fmt)


def incremental_gold(spark: SparkSession, silver_path: str, gold_path: str, checkpoint: str, sentiment: str | None = "sentiment",
                     trigger: dict | None = None, fmt: str = "parquet") -> StreamingQuery:
    """A stream over the files of silver that keeps gold up to date."""
    schema = spark.read.format(fmt).load(silver_path).schema
    files = spark.readStream.schema(schema).format(fmt).load(silver_path)

    def refresh(batch: DataFrame, epoch_id: int) -> None:
        space = Workspace(batch.sparkSession, "touched")
        touched = space.put(batch.select(*PLACE).distinct())
        if not touched.isEmpty():
            refresh_gold(batch.sparkSession.read.schema(schema).format(fmt).load(silver_path), touched, gold_path, sentiment, fmt)
        space.drop(touched)

    return RUN.start_foreach_batch(files, checkpoint, refresh, trigger=trigger)


def read_gold(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path).drop("partition_date")
