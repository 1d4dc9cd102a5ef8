"""What several operators need around their Spark jobs: stored steps and files in the shared folder."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.session import scratch_path

__all__ = ["scratch_path"]

ROWS_AT_ONCE = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _swept(spark: SparkSession) -> None:
    """Let shuffle files of steps that are over go.

    Spark drops the shuffle files of frames that nobody holds when the driver collects its garbage,
    which a driver with little to do does rarely.
    """
    gc.collect()
    spark._jvm.System.gc()


def store(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder, to cut its lineage; the files outlive a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, ROWS_AT_ONCE)  # whole texts: fewer to a batch than numbers
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_BATCH_ROWS, before)
    _swept(spark)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete stored steps whose last reader has written its own result."""
    for df in stored:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def squeezed(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a text column as compressed bytes, for joins that move whole texts."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            at = batch.schema.get_field_index(name)
            texts = (batch.column(at)[k].as_buffer() for k in range(batch.num_rows))
            yield batch.set_column(at, name, pa.array([press.compress(t) for t in texts], pa.binary()))

    fields = [T.StructField(f.name, T.BinaryType()) if f.name == name else f for f in df.schema]
    return df.mapInArrow(squeeze, T.StructType(fields))


def expanded(batches: Iterator[pa.RecordBatch], name: str, at_most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The texts of ``squeezed`` again, in batches of about ``at_most`` bytes."""
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        at = batch.schema.get_field_index(name)
        begin, held, size = 0, [], 0
        for k in range(batch.num_rows):
            held.append(press.decompress(batch.column(at)[k].as_buffer()))
            size += len(held[-1])
            if size >= at_most or k == batch.num_rows - 1:
                yield batch.slice(begin, len(held)).set_column(at, name, pa.array(held, pa.binary()))
                begin, held, size = k + 1, [], 0


def bytes_of(docs: DataFrame, column: str) -> int:
    """Bytes in a text column, all rows."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def task_count(spark: SparkSession, volume: int, per_task: int) -> int:
    """Partitions for a step that handles ``volume``: at most ``per_task`` each, and one per core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-volume // per_task))


def task_number() -> int:
    return TaskContext.get().partitionId()


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


@contextmanager
def published(uri: str):
    """A file that appears under its name when it is whole; a second attempt of a task replaces it."""
    system, path = _at(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    partial = f"{path}.{uuid.uuid4().hex}.partial"
    with system.open_output_stream(partial, compression=None) as out:
        yield out
    system.move(partial, path)


def open_input(uri: str):
    system, path = _at(uri)
    return system.open_input_file(path)
