"""The stored tables: external parquet tables in one database per layer.

A write never touches files that someone may be reading, and a reader sees the whole old or the whole new table.

A table without partition columns is one catalog table; a write fills a new folder and moves the table's location there.

A table with partition columns is a view. Every full refresh makes a *generation*: a catalog table of its own, whose
partitions Spark registers from the write itself. Its rows also carry the version that wrote them. The refresh ends when the
view is altered to read the new generation, one step in the catalog. An upsert that keeps to some partitions adds a version of
just these to the generation, and then the list of live versions, a small table with a row per partition that the view
joins, moves to its next state. The view's join prunes folders that are out of date while it runs (dynamic partition pruning).
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bodega.functions.rules import instant
from bodega.operators.upsert import merged, require_unambiguous
from bodega.schemas import SYNC_STAMP, TABLES, TRANSFORM_STAMP, TableSpec, conform, spec_of
from bodega.session import materialise

STAMPS = {"bronze": SYNC_STAMP, "silver": TRANSFORM_STAMP}
VERSION, PART = "_version", "_part"
CODEC = "zstd"
_GENERATION, _LIVE = "__g", "__live"
_NULL = "__HIVE_DEFAULT_PARTITION__"


def stamped(df: DataFrame, layer: str, run_ts: dt.datetime | None) -> DataFrame:
    """``df`` with the audit column of the layer, replacing one that came with the source."""
    if layer not in STAMPS:
        return df
    return df.withColumn(STAMPS[layer], F.current_timestamp() if run_ts is None else instant(run_ts))


def balanced(df: DataFrame, partition: Sequence[str] = ()) -> DataFrame:
    """``df`` arranged for writing: rows of one table partition together, in pieces of even size.

    The rebalance lets AQE merge small pieces and cut a partition that holds much of the table.
    """
    return df.hint("rebalance", *partition) if partition else df


def part_of(partition: Sequence[str], alias: str = "") -> str:
    """The SQL text of a row's partition, as the catalog lists it. Declared partition columns are dates and numbers."""
    each = (f"'{name}=', coalesce(CAST({alias}{name} AS STRING), '{_NULL}')" for name in partition)
    return f"concat({", '/', ".join(each)})"


def _new_id() -> str:
    """A name that sorts by time."""
    return f"{dt.datetime.now():%Y%m%dt%H%M%S%f}{uuid.uuid4().hex[:8]}"


class Warehouse:
    """Tables below ``root``; ``prefix`` keeps several warehouses apart in one catalog.

    ``partitions`` overrides the declared partition columns of single tables, for instance to store a mart
    with a few rows per day in plain files instead of a folder per day.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        prefix: str = "",
        partitions: Mapping[str, Sequence[str]] | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self.partitions = {table: tuple(columns) for table, columns in (partitions or {}).items()}

    def spec(self, table: str) -> TableSpec:
        declared = spec_of(table)
        return replace(declared, partition=self.partitions.get(table, declared.partition))

    def name(self, table: str) -> str:
        spec = spec_of(table)
        return f"{self.prefix}{spec.layer}.{spec.name}"

    def create(self, tables: Sequence[str] = tuple(TABLES)) -> None:
        """Declare the databases and the tables that do not exist yet."""
        for table in tables:
            spec = self.spec(table)
            self._database(spec)
            if not self.spark.catalog.tableExists(self.name(table)):
                if spec.partition:
                    self._show(spec, self._generation(spec))
                else:
                    self._plain(spec, f"{self._folder(spec)}/empty")

    def read(self, table: str) -> DataFrame:
        """A stored table with its declared columns in their declared order."""
        name = self.name(table)
        if not self.spark.catalog.tableExists(name):
            database = name.split(".")[0]
            known = self.spark.catalog.databaseExists(database)
            present = {t.name for t in self.spark.catalog.listTables(database)} if known else set()
            present = sorted(present & {spec.name for spec in TABLES.values()})
            raise LookupError(f"no table {name}; {database} has: {', '.join(present) or 'no tables'}")
        return self.spark.table(name).select(*spec_of(table).names)

    def overwrite(self, table: str, df: DataFrame, run_ts: dt.datetime | None = None) -> int:
        """Replace the whole table and give the number of rows written. Columns are matched by name."""
        spec = self.spec(table)
        arranged = balanced(conform(stamped(df, spec.layer, run_ts), table), spec.partition)
        written = Observation()
        self._replace(spec, arranged.observe(written, F.count(F.lit(1)).alias("rows")))
        return written.get["rows"]

    def upsert(
        self, table: str, updates: DataFrame, keys: Sequence[str], run_ts: dt.datetime | None = None
    ) -> None:
        """Replace the rows that match ``updates`` on ``keys`` and add the others.

        When the keys include the partition columns, only the partitions with updates are read and rewritten: a
        semi join on the partition prunes the target's scan, so the partitions never pass through the driver.
        """
        spec = self.spec(table)
        batch = materialise(conform(stamped(updates, spec.layer, run_ts), table), f"updates-{spec.name}")
        target = self.read(table)
        partial = bool(spec.partition) and set(spec.partition) <= set(keys)
        if partial:
            target = self._touched(spec, target, batch)
        require_unambiguous(target, batch, keys)
        result = balanced(merged(target, batch, keys), spec.partition)
        if partial:
            self._add_version(spec, result)
        else:
            self._replace(spec, result)

    def drift(self) -> list[tuple[str, str, str | None, str | None]]:
        """(table, column, declared type, stored type) wherever the catalog or the files differ from the declaration."""
        found = set()
        for table, spec in ((table, self.spec(table)) for table in TABLES):
            declared = {column: kind.lower() for column, kind in spec.columns}
            if not self.spark.catalog.tableExists(self.name(table)):
                found.add((table, "", "table", None))
                continue
            views = [self.spark.table(self.name(table)).schema]
            sample = self.spark.table(self._files(spec)).select("_metadata.file_path").first()
            if sample:
                views.append(self.spark.read.parquet(sample.file_path).schema)
            for at, schema in enumerate(views):
                wanted = {c: k for c, k in declared.items() if not at or c not in spec.partition}
                stored = {field.name: field.dataType.simpleString() for field in schema}
                for column in wanted.keys() | stored.keys():
                    if wanted.get(column) != stored.get(column):
                        found.add((table, column, wanted.get(column), stored.get(column)))
        return sorted(found, key=repr)

    def _folder(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.layer}/{spec.name}"

    def _database(self, spec: TableSpec) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{spec.layer}")

    def _table(self, name: str, columns: str, path: str, partition: Sequence[str] = ()) -> None:
        by = f"PARTITIONED BY ({', '.join(partition)})" if partition else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS (compression '{CODEC}') {by} LOCATION '{path}'"
        )

    def _plain(self, spec: TableSpec, path: str) -> None:
        self._database(spec)
        self._table(self.name(spec.key), spec.ddl, path)

    def _move(self, name: str, path: str) -> None:
        self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        self.spark.sql(f"REFRESH TABLE {name}")

    def _replace(self, spec: TableSpec, df: DataFrame) -> None:
        if spec.partition:
            generation = self._generation(spec)
            version = self._append(spec, generation, df)
            self._show(spec, generation, version)
            return
        path = f"{self._folder(spec)}/{_new_id()}"
        df.write.parquet(path, compression=CODEC)
        if self.spark.catalog.tableExists(self.name(spec.key)):
            self._move(self.name(spec.key), path)
        else:
            self._plain(spec, path)

    # --- partitioned tables ---

    def _touched(self, spec: TableSpec, target: DataFrame, batch: DataFrame) -> DataFrame:
        """The rows of ``target`` in partitions that ``batch`` has rows of; the scan skips the others while it runs."""
        part = F.expr(part_of(spec.partition)).alias(PART)
        # Spark prunes by a join side only if that has a filter of its own; no partition comes before ''.
        parts = batch.select(part).distinct().filter(F.col(PART) > "")
        return target.select("*", part).join(parts, PART, "left_semi").drop(PART)

    def _generation(self, spec: TableSpec) -> str:
        """An empty catalog table for one full refresh."""
        self._database(spec)
        own = _new_id()
        name = f"{self.name(spec.key)}{_GENERATION}{own}"
        columns = f"{spec.ddl}, {VERSION} STRING"
        self._table(name, columns, f"{self._folder(spec)}/{own}", [VERSION, *spec.partition])
        return name

    def _files(self, spec: TableSpec) -> str:
        """The catalog table that holds the rows: the generation that the view reads, or the table itself."""
        return self._shown(spec)[0] if spec.partition else self.name(spec.key)

    def _shown(self, spec: TableSpec) -> tuple[str, str]:
        """The generation that the view reads, and its version if that is the only one."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(spec.key)}")
        text = described.filter("col_name = 'View Text'").first().data_type
        only = re.search(rf"WHERE {VERSION} = '(\w*)'", text)
        return re.search(rf"FROM (\S+{_GENERATION}\w+)", text).group(1), only.group(1) if only else ""

    def _append(self, spec: TableSpec, generation: str, df: DataFrame) -> str:
        """Add a version to the generation; nobody reads it yet. The write registers its partitions."""
        version = _new_id()
        others = [name for name in spec.names if name not in spec.partition]
        df.select(*others, F.lit(version).alias(VERSION), *spec.partition).write.insertInto(generation)
        return version

    def _show(self, spec: TableSpec, generation: str, version: str = "") -> None:
        """Let the view read one version of a generation. Of earlier generations the last stays for its readers."""
        live = f"{generation}{_LIVE}"
        text = f"SELECT {', '.join(spec.names)} FROM {generation}"
        if self.spark.catalog.tableExists(live):
            # Nobody compares a version with '' in earnest; the filter is what lets Spark prune by this side.
            text = f"""SELECT {', '.join(f'files.{name}' for name in spec.names)} FROM {generation} AS files JOIN {live} AS live
                ON files.{VERSION} = live.{VERSION} AND {part_of(spec.partition, 'files.')} = live.{PART}
                WHERE live.{VERSION} > ''"""
        else:
            text += f" WHERE {VERSION} = '{version}'"
        name = self.name(spec.key)
        verb = "ALTER" if self.spark.catalog.tableExists(name) else "CREATE"
        self.spark.sql(f"{verb} VIEW {name} AS {text}")
        self._forget(spec)

    def _forget(self, spec: TableSpec) -> None:
        """Take generations before the last two out of the catalog; their files stay."""
        database, own = self.name(spec.key).split(".")
        pattern = re.compile(rf"{re.escape(own)}{_GENERATION}\w+")
        known = sorted(t.name for t in self.spark.catalog.listTables(database) if pattern.fullmatch(t.name))
        for old in [name for name in known if not name.endswith(_LIVE)][:-2]:
            for name in (f"{old}{_LIVE}", old):
                self.spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")

    def _parts(self, generation: str, version: str) -> DataFrame:
        """(part, version) of one version from the catalog's own list."""
        listed = self.spark.sql(f"SHOW PARTITIONS {generation} PARTITION ({VERSION} = '{version}')")
        return listed.select(F.regexp_replace("partition", "^[^/]*/", "").alias(PART), F.lit(version).alias(VERSION))

    def _add_version(self, spec: TableSpec, df: DataFrame) -> None:
        """Replace the partitions that ``df`` has rows of. One writer at a time: of two, the later one wins."""
        generation, only = self._shown(spec)
        live = f"{generation}{_LIVE}"
        known = self.spark.catalog.tableExists(live)
        before = self.spark.table(live) if known else self._parts(generation, only)
        after = self._parts(generation, self._append(spec, generation, df))
        path = f"{self._folder(spec)}/live/{_new_id()}"
        before.join(after, PART, "left_anti").unionByName(after).coalesce(1).write.parquet(path, compression=CODEC)
        if known:
            self._move(live, path)
        else:
            self._table(live, f"{PART} STRING, {VERSION} STRING", path)
            self._show(spec, generation)
