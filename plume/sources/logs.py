"""Collector log lines (S14) and health classification.

A log line is ``yyyy-MM-dd HH:mm:ss - message``. Files are read with
``spark.read.text`` (one row per line, split across tasks like any text
file); order within a file comes from the leading timestamp, so no task
ever needs a whole file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.time import as_of_lit

# Patterns the dashboard looks for in the recent lines.
RATE_LIMIT_PATTERN = r"(?i)rate limit|429|too many requests"
SUCCESS_PATTERN = r"(?i)successfully|✅|sent to kafka|collected and sent"
ERROR_PATTERN = r"(?i)error|❌|failed"
LINE_TIME = r"^(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2})"


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of every file under ``path`` with file name and parsed time."""
    t = spark.read.text(path)
    return t.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"),
                    F.try_to_timestamp(F.regexp_extract("value", LINE_TIME, 1)).alias("ts"),
                    F.col("value").alias("line"))


def log_tail(lines: DataFrame, n: int = 20, as_of=None) -> DataFrame:
    """Last n lines of each file (up to the clock). ``row_number() <= n`` is
    planned with a map-side group limit: a huge file ships n rows per task."""
    if as_of is not None:
        lines = lines.where(F.col("ts") <= as_of_lit(as_of))
    w = Window.partitionBy("file").orderBy(F.desc("ts"), F.desc("line"))
    return lines.withColumn("pos", F.row_number().over(w).cast("bigint")).where(F.col("pos") <= n)


def collector_health(lines: DataFrame, as_of, n: int = 20, idle_after_s: int = 300) -> DataFrame:
    """Status per file from its last n lines: limited > running > error
    > idle, and idle whenever the newest line is older than ``idle_after_s``."""
    tail = log_tail(lines, n, as_of)
    agg = tail.groupBy("file").agg(
        F.max(F.col("line").rlike(RATE_LIMIT_PATTERN)).alias("rate_limited"),
        F.max(F.col("line").rlike(SUCCESS_PATTERN)).alias("last_success"),
        F.max(F.col("line").rlike(ERROR_PATTERN)).alias("has_error"),
        F.max("ts").alias("last_line_at"),
    )
    silent = (F.unix_seconds(as_of_lit(as_of)) - F.unix_seconds(F.col("last_line_at"))) > idle_after_s
    status = (F.when(silent, "idle").when(F.col("rate_limited"), "limited")
              .when(F.col("last_success"), "running").when(F.col("has_error"), "error").otherwise("idle"))
    return agg.withColumn("status", status)
