"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def build_session(
    app: str = "bodega", master: str | None = None, settings: Mapping[str, str] | None = None
) -> SparkSession:
    """A session with the settings every job here relies on; ``settings`` win over the defaults.

    ANSI mode makes a narrowing cast raise instead of storing NULL. The time zone decides
    which calendar day and hour a sale belongs to, so it is always explicit. A table with a folder per day costs a
    file per folder, however little that holds: with the usual floor of 1 MB to a partition one task would write thousands of
    folders one after the other, so the floor is lower and a write keeps all cores busy.
    """
    defaults = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32KB",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**defaults, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scale_settings(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Scan and shuffle settings for an input size: as many reducers as hold ``partition_bytes`` each.

    AQE merges partitions but splits only skewed ones, so the starting number has to suit the largest shuffle, at
    every size alike; a larger ``partition_bytes`` gives fewer.
    """
    reducers = max(1, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(reducers),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="bodega-")
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/bodega/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage of a frame that several outputs need. Unlike cached blocks the files outlive
    a lost executor, and unlike a checkpoint each reader fetches only the columns it uses.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def each(function: Callable, items: Iterable, at_once: int = 4) -> list:
    """``function`` of every item, several at a time, so that small jobs share the cluster with large ones."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(function, items))
