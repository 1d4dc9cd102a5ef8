"""The KPI subset handed to outside readers."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bodega.sinks.warehouse import Warehouse

SHARED_TABLES = ("gold.fact_kpis_diarios", "gold.fact_kpis_inventario")
MANIFEST = "tabla string, filas bigint, huella decimal(38,0), ruta string, publicado timestamp"


class ContentMismatch(ValueError):
    """A published copy does not hold what its manifest entry says."""


def _content(df: DataFrame) -> list[Column]:
    """Row count and a sum of row hashes: the same for the same rows in any order or files."""
    print_of = F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("filas"), F.coalesce(print_of, F.lit(0).cast("decimal(38,0)")).alias("huella")]


def publish(warehouse: Warehouse, target: str, published: dt.datetime) -> DataFrame:
    """Copy the shared tables below ``target`` and give the new manifest rows: tabla, filas, huella, ruta, publicado.

    Every publication is a folder of its own, plain parquet without partition folders, so a reader needs no catalog and
    one who is still reading the previous copy keeps it. Rows and fingerprint are counted during the copy. The
    manifest grows last: until then nobody sees the new copies. Nothing else of the warehouse is exposed.
    """
    root, version = target.rstrip("/"), uuid.uuid4().hex
    entries = []
    for table in SHARED_TABLES:
        path = f"{root}/{table.split('.')[1]}/{version}"
        copied = Observation()
        rows = warehouse.read(table)
        rows.observe(copied, *_content(rows)).write.parquet(path)
        entries.append((table, copied.get["filas"], copied.get["huella"], path, published))
    manifest = warehouse.spark.createDataFrame(entries, MANIFEST)
    manifest.write.mode("append").parquet(f"{root}/manifest")
    return manifest


def shared(spark: SparkSession, target: str, table: str) -> DataFrame:
    """The copy of ``table`` that was published last, checked against its manifest entry in one pass.

    Two copies of the same instant count as one state.
    """
    entries = spark.read.schema(MANIFEST).parquet(f"{target.rstrip('/')}/manifest").filter(F.col("tabla") == table)
    newest = entries.orderBy(F.desc("publicado"), "ruta").first()
    if newest is None:
        raise LookupError(f"{table} is not published in {target}")
    rows = spark.read.parquet(newest.ruta)
    found = rows.agg(*_content(rows)).first()
    if (found.filas, found.huella) != (newest.filas, newest.huella):
        raise ContentMismatch(f"{newest.ruta}: {found.filas} rows, published were {newest.filas}, or other content")
    return rows
