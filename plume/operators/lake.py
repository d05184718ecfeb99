"""Table upkeep as plain Spark jobs.

Without a transactional table format these rewrite whole partitions with
dynamic partition overwrite: each partition swap is atomic per folder, but
a job touching several partitions is *not* atomic across them. Use Delta or
Iceberg (``format=...``) where that matters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys, version: str) -> DataFrame:
    """Newest row per key by ``version`` (``max_by`` – partial aggregate,
    so a key with a huge history is merged map-side, never sorted in one task);
    of equal versions the row with the greatest hash, on every run the same."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    newest = F.struct(F.col(version), F.xxhash64(*rest))
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), newest).alias("_r"))
            .select(*keys, "_r.*"))


def upsert(base: DataFrame, updates: DataFrame, keys, version: str) -> DataFrame:
    """Matched → update all, not matched → insert all; the newest version
    of each key wins (ties keep the update, then the greatest hash). Applying it twice changes nothing."""
    tagged = (base.withColumn("_side", F.lit(0)).unionByName(updates.withColumn("_side", F.lit(1)),
                                                             allowMissingColumns=True))
    keys = list(keys)
    rest = [c for c in tagged.columns if c not in keys]
    ver = F.struct(F.col(version), F.col("_side"), F.xxhash64(*rest))
    return (tagged.groupBy(*keys).agg(F.max_by(F.struct(*rest), ver).alias("_r"))
            .select(*keys, "_r.*").drop("_side"))


def as_of(history: DataFrame, keys, version: str, t) -> DataFrame:
    """L2: the table as it was at time ``t``: newest row per key among the
    rows written at or before ``t``."""
    cut = history.where(F.col(version) <= F.lit(str(t)).cast("timestamp"))
    return latest_per_key(cut, keys, version)


def write_partitioned(df: DataFrame, path: str, partition_cols, mode: str = "append",
                      fmt: str = "parquet") -> None:
    """Batch append (or overwrite) partitioned by the given columns.
    A ``rebalance`` hint clusters rows by the partition columns so each task
    writes few, large files; AQE splits a hot partition (one day or network
    holding a third of the rows) across tasks instead of one straggler."""
    cols = list(partition_cols)
    df.hint("rebalance", *cols).write.mode(mode).format(fmt).partitionBy(*cols).save(path)


def overwrite_partitions(spark: SparkSession, df: DataFrame, path: str, partition_cols,
                         fmt: str = "parquet") -> None:
    """Dynamic partition overwrite: only partitions present in ``df`` are replaced."""
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.write.mode("overwrite").format(fmt).partitionBy(*partition_cols).save(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def delete_where(spark: SparkSession, path: str, predicate: str, partition_cols,
                 staging: str, fmt: str = "parquet") -> None:
    """L1: delete rows matching ``predicate``. The touched partitions are read,
    filtered, staged to ``staging`` (cutting the read-from-self lineage) and
    swapped in by dynamic overwrite. Touched partitions with no row left are
    dropped as folders (their list is partition metadata, not data)."""
    table = spark.read.format(fmt).load(path)
    cols = list(partition_cols)
    touched = table.where(predicate).select(*cols).distinct()
    same = [table[c].eqNullSafe(F.col(f"_{c}")) for c in cols]
    # A row for which the predicate is unknown is not a match: it stays.
    keep = table.join(touched.toDF(*[f"_{c}" for c in cols]), same, "left_semi").where(f"NOT coalesce(({predicate}), false)")
    keep.write.mode("overwrite").format(fmt).save(staging)
    staged = spark.read.format(fmt).load(staging)
    emptied = touched.join(staged.select(*cols).distinct(), cols, "left_anti").collect()
    overwrite_partitions(spark, staged.select(*table.columns), path, cols, fmt)
    drop_partition_dirs(spark, path, cols, emptied)


def drop_partition_dirs(spark: SparkSession, path: str, cols, rows) -> None:
    """Remove ``col=value/...`` folders through the Hadoop file system API."""
    if not rows:
        return
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for r in rows:
        sub = "/".join(f"{c}={r[c]}" for c in cols)
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{sub}")
        p.getFileSystem(conf).delete(p, True)


def compact(spark: SparkSession, path: str, partition_cols, staging: str,
            fmt: str = "parquet") -> None:
    """L3: rewrite small files as few large ones. A ``rebalance`` hint on the
    partition columns lets AQE size the output by
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` (coalescing small
    groups, splitting big ones); the result is staged, then swapped in by
    dynamic overwrite."""
    table = spark.read.format(fmt).load(path)
    staged_path = staging
    (table.hint("rebalance", *partition_cols).write.mode("overwrite").format(fmt)
     .partitionBy(*partition_cols).save(staged_path))
    overwrite_partitions(spark, spark.read.format(fmt).load(staged_path).select(*table.columns),
                         path, partition_cols, fmt)


def zorder_key(*cols, bits: int = 16) -> F.Column:
    """L4: Morton (bit-interleaved) key over columns already scaled to
    non-negative integers below 2^bits – built from shifts and masks only."""
    key = F.lit(0).cast("bigint")
    n = len(cols)
    for b in range(bits):
        for i, c in enumerate(cols):
            bit = F.shiftright(F.col(c).cast("bigint") if isinstance(c, str) else c.cast("bigint"), b) \
                .bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(bit, b * n + i))
    return key


def zorder(df: DataFrame, cols, num_partitions: int, bits: int = 16) -> DataFrame:
    """L4: cluster rows by a Z-order key. Each column is scaled into
    [0, 2^bits) by its min/max – all bounds from one aggregate used as a
    scalar subquery (no join, no global sort) – then rows are
    range-partitioned on the interleaved key and sorted within partitions,
    so data skipping works on every key column. Meant for a stored table:
    the bounds and the range sampling each read the input once more."""
    top = (1 << bits) - 1
    bounds = df.agg(F.struct(*[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
                             *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)])).scalar()
    scaled = df
    for i, c in enumerate(cols):
        lo, hi = bounds[f"lo{i}"], bounds[f"hi{i}"]
        v = F.col(c).cast("double")
        scaled = scaled.withColumn(
            f"_z{i}", F.when(hi > lo, F.floor((v - lo) / (hi - lo) * top)).otherwise(F.lit(0)).cast("bigint"))
    keyed = scaled.withColumn("_zkey", zorder_key(*[f"_z{i}" for i in range(len(cols))], bits=bits))
    return (keyed.drop(*[f"_z{i}" for i in range(len(cols))])
            .repartitionByRange(num_partitions, "_zkey").sortWithinPartitions("_zkey"))


def retention_keep(df: DataFrame, as_of, days: int, date_col: str = "partition_date") -> DataFrame:
    """Partitions younger than ``days`` before the clock (a partition
    predicate, so the scan prunes folders instead of reading them)."""
    cut = F.date_sub(F.to_date(F.lit(str(as_of)).cast("timestamp")), days)
    return df.where(F.col(date_col) >= cut)


def read_merged(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read files written with different column sets as one schema."""
    return spark.read.option("mergeSchema", "true").format(fmt).load(path)
