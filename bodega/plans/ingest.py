"""Source tables into bronze."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from bodega.session import each
from bodega.sinks.warehouse import Warehouse

# Gives the source rows of a bronze table.
Reader = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Loaded:
    table: str
    rows: int
    ok: bool
    error: str | None = None


def load(warehouse: Warehouse, read: Reader, table: str, run_ts: dt.datetime | None) -> Loaded:
    """Replace one bronze table; a failure is reported, not raised. The row count is that of the write."""
    try:
        rows = warehouse.overwrite(f"bronze.{table}", read(table), run_ts)
    except Exception as problem:  # whatever the source raises belongs in the report
        return Loaded(table, 0, False, str(problem).splitlines()[0])
    return Loaded(table, rows, True)


def load_all(
    warehouse: Warehouse, read: Reader, tables: Iterable[str], run_ts: dt.datetime | None = None
) -> list[Loaded]:
    return each(lambda table: load(warehouse, read, table, run_ts), tables)


def status(results: list[Loaded]) -> str:
    done = sum(result.ok for result in results)
    return "SUCCESS" if done == len(results) else f"PARTIAL: {done}/{len(results)}"


def summary(spark: SparkSession, results: list[Loaded]) -> DataFrame:
    rows = [(result.table, result.rows, result.ok, result.error) for result in results]
    return spark.createDataFrame(rows, "tabla string, filas bigint, ok boolean, error string")
