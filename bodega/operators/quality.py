"""How many rows each step of the refresh gets and lets through, counted while the tables are written.

The counts ride along with the writes as observed metrics, so no table is read a second time. A task that runs again after
its executor was lost can be counted twice by Spark; the number of rows written is that of the final write.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

READ, ALL_CHECKS, UNIQUE, RECONCILED, WRITTEN = "leidas", "todas", "unicas", "conciliadas", "escritas"
SCHEMA = "capa string, tabla string, regla string, filas_entrada bigint, filas_validas bigint"


class StepCounts:
    """The counts of one refresh: per layer, table and rule the rows that reach it and those that pass."""

    def __init__(self) -> None:
        self._seen: list[tuple[str, str, list[str], Observation]] = []
        self._written: list[tuple[str, str, int]] = []
        self._lock = threading.Lock()

    def through(self, df: DataFrame, layer: str, table: str, rules: Mapping[str, str | Column]) -> DataFrame:
        """``df``, with the rows that pass each rule counted when it is written."""
        seen = Observation()
        passed = [F.count_if(rule if isinstance(rule, Column) else F.expr(rule)).alias(name) for name, rule in rules.items()]
        with self._lock:
            self._seen.append((layer, table, list(rules), seen))
        return df.observe(seen, F.count(F.lit(1)).alias(READ), *passed)

    def written(self, layer: str, table: str, rows: int) -> None:
        with self._lock:
            self._written.append((layer, table, rows))

    def rows(self) -> list[tuple[str, str, str, int, int]]:
        """(layer, table, rule, rows in, rows passing); waits for the writes that have not ended."""
        found = []
        for layer, table, rules, seen in self._seen:
            counts = seen.get
            found += [(layer, table, rule, counts[READ], counts[rule]) for rule in rules]
        found += [(layer, table, WRITTEN, rows, rows) for layer, table, rows in self._written]
        return sorted(found)

    def report(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), SCHEMA)
