"""Small Spark helpers for the operators."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from plume.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Also sees to it that executors can import this package."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send the package to the executors through Spark, once a context; a job started
    with ``--py-files`` has it already."""
    context = spark.sparkContext
    if any(os.path.basename(f).startswith("plume") for f in getattr(context, "_python_includes", [])):
        return
    import plume

    root = Path(plume.__file__).parent
    if root.parent.suffix == ".zip":
        return
    target = Path(tempfile.mkdtemp(prefix="plume-package-")) / "plume.zip"  # the driver serves it
    with zipfile.ZipFile(target, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, f"plume/{file.relative_to(root)}")
    context.addPyFile(str(target))


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def tidy(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are over. It does so when the driver collects its garbage, which a
    driver with little to do puts off while its executors' disks fill."""
    gc.collect()
    spark._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that no later step reads; what was made of them must be stored itself by then."""
    tidy(tables[0].sparkSession)
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release() -> None:
    """Give freed memory back to the system. Workers are used again, and what one stage held would stay with the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], dict], schema: str,
                column: str = "text") -> DataFrame:
    """Arrow map over byte-bounded slices; ``function`` gives the output columns of a slice."""
    from plume.llm import textbatch

    target = pa_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in textbatch.slices(batches, column):
            made = function(part)
            yield pa.RecordBatch.from_arrays([as_array(made[f.name], f.type) for f in target], schema=target)
        release()

    return df.mapInArrow(run, schema)


def as_array(values, type_: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == type_ else values.cast(type_)
    return pa.array(values, type_)


def pa_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def text_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns; extra columns of the table never reach the operator."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front as long as the table has such columns itself."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def map_whole(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              known: tuple[str, ...] = ("text",), drop: tuple[str, ...] = (), longs: tuple[str, ...] = ()) -> DataFrame:
    """``mapInArrow`` over all columns whatever their names: only the ``known`` ones keep theirs inside. ``run``
    returns the columns in order without the ``drop`` ones, then ``longs``, whole numbers."""
    inside = [c if c in known else f"column{i}" for i, c in enumerate(df.columns)]
    kept = [i for i, c in enumerate(df.columns) if c not in drop]
    schema = StructType([StructField(inside[i], df.schema.fields[i].dataType) for i in kept]
                        + [StructField(c, LongType()) for c in longs])
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return df.toDF(*inside).mapInArrow(whole, schema).toDF(*[df.columns[i] for i in kept], *longs)
