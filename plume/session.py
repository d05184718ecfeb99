"""Session helpers: builder for tests/bench, UTC pinning, checkpoint folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", app: str = "plume",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. A cluster job keeps its own conf."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Every clock-relative operator assumes a UTC session (quirk Q16)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage cuts.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    store every executor can reach); without it a cluster job stops here.
    Only a local session (tests, a laptop), where driver and executors are
    one process, gets a fresh scratch folder, recorded in the session.
    """
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="plume-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, root)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root."""
    import uuid

    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there, in whatever store it lies."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark._jsc.hadoopConfiguration()).exists(own)


class Workspace:
    """Tables that one job stores in the shared folder, one after another.

    ``put`` writes a table and reads it back: lineage ends there, so a lost
    executor costs one step. ``drop`` deletes tables that no later step reads,
    once their successor is written.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root, self._n = spark, scratch_path(spark, name), 0

    def put(self, df: DataFrame, *replaces: DataFrame) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n}"
        df.write.parquet(path)
        for old in replaces:
            self.drop(old)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stored_at = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
