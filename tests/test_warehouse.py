from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import AS_OF, RUN_TS, SMALL
from pyspark.sql import functions as F

from bodega.operators.upsert import AmbiguousUpdate
from bodega.schemas import GOLD, SILVER, TABLES, conform, schema_rows
from bodega.plans import pipeline
from bodega.sinks.share import ContentMismatch, publish, shared
from bodega.sources.tpch import COLUMNS, TpchTables

STOCK = "silver.inventario_clean"
KPIS = "gold.fact_kpis_diarios"
LINES = "silver.detalle_ventas_clean"


@pytest.fixture
def stock(spark):
    def make(rows):
        full = [(lot, 1, branch, quantity, RUN_TS, None, 999, "Optimo", "Stock OK") for lot, branch, quantity in rows]
        return spark.createDataFrame(full, SILVER["inventario_clean"])

    return make


@pytest.fixture
def kpis(spark):
    def make(rows):
        full = [
            (day, branch, Decimal(sales), 1, Decimal(1), None, 1, None, 0, Decimal(1), Decimal(2), Decimal(3))
            for day, branch, sales in rows
        ]
        return spark.createDataFrame(full, GOLD["fact_kpis_diarios"])

    return make


def quantities(warehouse):
    rows = warehouse.read(STOCK).select("inventario_id", "sucursal_id", "cantidad").collect()
    return sorted(map(tuple, rows), key=repr)


def rows_by_file(warehouse, table):
    """The rows of the files behind a table."""
    return warehouse.spark.table(warehouse._files(warehouse.spec(table))).withColumn("file", F.col("_metadata.file_path"))


class Watching:
    """A session that runs ``check`` after every statement."""

    def __init__(self, spark, check):
        self._spark, self._check, self.statements = spark, check, []

    def __getattr__(self, name):
        return getattr(self._spark, name)

    def sql(self, text):
        result = self._spark.sql(text)
        self.statements.append(text)
        self._check()
        return result


def test_declares_all_tables(new_warehouse):
    warehouse = new_warehouse()
    warehouse.create()
    warehouse.create()
    assert len(TABLES) == 29
    for table, spec in TABLES.items():
        df = warehouse.read(table)
        assert df.columns == spec.names and df.isEmpty()
    assert len(schema_rows()) == sum(len(spec.columns) for spec in TABLES.values())


def test_identifiers_are_wide_enough_for_large_tables():
    kinds = {kind for spec in TABLES.values() for name, kind in spec.columns if name == "id" or name.endswith("_id")}
    assert kinds == {"BIGINT"}


def test_partitioned_write_goes_by_name(new_warehouse, stock):
    warehouse = new_warehouse()
    shuffled = stock([(1, 10, 5), (2, 20, 6)]).select(*reversed(stock([]).columns))
    assert warehouse.overwrite(STOCK, shuffled, RUN_TS) == 2
    assert quantities(warehouse) == [(1, 10, 5), (2, 20, 6)]
    row = warehouse.read(STOCK).filter("sucursal_id = 10").first()
    assert row._transform_timestamp == RUN_TS and row.estado_caducidad == "Optimo"


def test_overwrite_drops_partitions_that_are_gone(new_warehouse, stock):
    warehouse = new_warehouse()
    warehouse.overwrite(STOCK, stock([(1, 10, 5), (2, 20, 6)]))
    warehouse.overwrite(STOCK, stock([(3, 20, 7), (4, None, 8)]))
    assert quantities(warehouse) == [(3, 20, 7), (4, None, 8)]
    warehouse.overwrite(STOCK, stock([]))
    assert quantities(warehouse) == []


def test_a_table_can_be_rewritten_from_itself(new_warehouse, stock):
    warehouse = new_warehouse()
    warehouse.overwrite(STOCK, stock([(1, 10, 5)]))
    warehouse.overwrite(STOCK, warehouse.read(STOCK).withColumn("cantidad", F.col("cantidad") + 1))
    assert quantities(warehouse) == [(1, 10, 6)]


def test_a_failed_write_leaves_the_table_as_it_was(new_warehouse, spark):
    warehouse = new_warehouse()
    good = spark.createDataFrame([(1, 1, 1, Decimal(1), Decimal(1), Decimal(1))], SILVER["detalle_ventas_clean"])
    warehouse.overwrite(LINES, good, RUN_TS)
    too_large = good.withColumn("subtotal", F.lit(Decimal("99999999999.00")))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        warehouse.overwrite(LINES, too_large, RUN_TS)
    assert warehouse.read(LINES).first().subtotal == 1


def test_a_value_that_does_not_fit_fails_without_ansi_too(new_warehouse, spark, stock):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        warehouse = new_warehouse()
        warehouse.overwrite(STOCK, stock([(1, 10, 5), (2, 10, None)]))
        too_large = stock([(1, 10, 5)]).withColumn("cantidad", F.lit(1 << 40))
        with pytest.raises(Exception, match="cantidad: value does not fit INT"):
            warehouse.overwrite(STOCK, too_large)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert quantities(warehouse) == [(1, 10, 5), (2, 10, None)]


def test_columns_must_match_the_declaration(stock):
    with pytest.raises(ValueError, match=r"missing columns \['_transform_timestamp', 'cantidad'\].*\['otra'\]"):
        conform(stock([]).withColumnRenamed("cantidad", "otra"), STOCK)


def test_missing_table_lists_the_present_ones(new_warehouse, stock):
    warehouse = new_warehouse()
    with pytest.raises(LookupError, match="no tables"):
        warehouse.read(LINES)
    warehouse.overwrite(STOCK, stock([(1, 10, 5)]))
    with pytest.raises(LookupError, match="has: inventario_clean"):
        warehouse.read(LINES)
    with pytest.raises(KeyError, match="unknown table"):
        warehouse.read("silver.nada")


def test_upsert_of_a_whole_table(new_warehouse, stock):
    """Without the partition column among the keys a row may move to another partition."""
    warehouse = new_warehouse()
    warehouse.overwrite(STOCK, stock([(1, 10, 5), (2, 20, 6)]))
    warehouse.upsert(STOCK, stock([(1, 30, 9), (3, 10, 1)]), ["inventario_id"])
    assert quantities(warehouse) == [(1, 30, 9), (2, 20, 6), (3, 10, 1)]


def test_upsert_rewrites_only_partitions_with_updates(new_warehouse, stock, spark):
    warehouse = new_warehouse()
    warehouse.overwrite(STOCK, stock([(1, 10, 5), (2, 20, 6), (3, 20, 7), (4, None, 8)]))

    written = rows_by_file(warehouse, STOCK).select("file").distinct()
    before = {row.file for row in written.collect()}
    keys = ["sucursal_id", "inventario_id"]
    warehouse.upsert(STOCK, stock([(2, 20, 60), (5, 50, 1), (4, None, 80)]), keys)
    added = rows_by_file(warehouse, STOCK).filter(~F.col("file").isin(*before))
    assert {row.sucursal_id for row in added.select("sucursal_id").distinct().collect()} == {20, 50, None}
    live = spark.table(f"{warehouse._files(warehouse.spec(STOCK))}__live").groupBy("_version").count()
    assert sorted(row["count"] for row in live.collect()) == [1, 3], "only branch 10 still reads its first files"
    # a NULL key matches nothing, so the lot without a branch is added next to the old one
    assert quantities(warehouse) == sorted(
        [(1, 10, 5), (2, 20, 60), (3, 20, 7), (4, None, 8), (4, None, 80), (5, 50, 1)], key=repr
    )
    warehouse.upsert(STOCK, stock([(2, 20, 61)]), keys)
    assert (2, 20, 61) in quantities(warehouse) and len(quantities(warehouse)) == 6


def test_a_reader_sees_the_whole_old_or_new_table_at_every_step(new_warehouse, stock, spark):
    warehouse = new_warehouse()
    states = [[(1, 10, 5), (2, None, 6)], [(1, 10, 7), (3, 30, 8)], [(1, 10, 9), (3, 30, 8), (4, 40, 1)]]
    warehouse.overwrite(STOCK, stock(states[0]))
    seen = []

    def check():
        rows = spark.table(warehouse.name(STOCK)).select("inventario_id", "sucursal_id", "cantidad").collect()
        seen.append(sorted(map(tuple, rows), key=repr))

    keys = ["sucursal_id", "inventario_id"]
    warehouse.spark = Watching(spark, check)
    warehouse.overwrite(STOCK, stock(states[1]))
    warehouse.upsert(STOCK, stock([(1, 10, 9), (4, 40, 1)]), keys)
    warehouse.upsert(STOCK, stock([(4, 40, 2)]), keys)
    states.append([(1, 10, 9), (3, 30, 8), (4, 40, 2)])
    assert [state for k, state in enumerate(seen) if state not in seen[:k]] == states
    order = [states.index(state) for state in seen]
    assert order == sorted(order)


def test_old_readers_keep_their_rows(new_warehouse, stock):
    warehouse = new_warehouse()
    warehouse.overwrite(STOCK, stock([(1, 10, 5)]))
    before = warehouse.read(STOCK)
    before.count()
    warehouse.overwrite(STOCK, stock([(1, 10, 6)]))
    assert before.first().cantidad == 5 and quantities(warehouse) == [(1, 10, 6)]


def test_statements_of_an_upsert_do_not_grow_with_partitions(new_warehouse, stock, spark):
    numbers = []
    for branches in (2, 40):
        warehouse = new_warehouse()
        warehouse.overwrite(STOCK, stock([(n, n, 1) for n in range(50)]))
        warehouse.spark = Watching(spark, lambda: None)
        warehouse.upsert(STOCK, stock([(n, n, 2) for n in range(branches)]), ["sucursal_id", "inventario_id"])
        numbers.append(len(warehouse.spark.statements))
        assert sum(q == 2 for _, _, q in quantities(warehouse)) == branches
    assert numbers[0] == numbers[1]


def test_upsert_skips_folders_without_updates_while_it_runs(new_warehouse, stock):
    warehouse = new_warehouse()
    warehouse.overwrite(STOCK, stock([(n, n, 1) for n in range(20)]))
    spec = warehouse.spec(STOCK)
    touched = warehouse._touched(spec, warehouse.read(STOCK), stock([(3, 3, 2)]))
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert [row.inventario_id for row in touched.collect()] == [3]
    warehouse.upsert(STOCK, stock([(3, 3, 2)]), ["sucursal_id", "inventario_id"])
    plan = warehouse.read(STOCK)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan, "folders of versions that are out of date are skipped too"


def test_a_failed_upsert_leaves_nothing_behind_for_the_next(new_warehouse, stock, monkeypatch):
    warehouse = new_warehouse()
    warehouse.overwrite(STOCK, stock([(1, 10, 5), (2, 20, 6)]))
    keys = ["sucursal_id", "inventario_id"]
    with monkeypatch.context() as broken:
        broken.setattr(warehouse, "_table", lambda *_: (_ for _ in ()).throw(OSError("catalog is down")))
        with pytest.raises(OSError, match="catalog is down"):
            warehouse.upsert(STOCK, stock([(1, 10, 50), (9, 90, 9)]), keys)
    assert quantities(warehouse) == [(1, 10, 5), (2, 20, 6)]
    warehouse.upsert(STOCK, stock([(2, 20, 60)]), keys)
    assert quantities(warehouse) == [(1, 10, 5), (2, 20, 60)]


def test_stored_types_are_the_declared_ones_after_a_refresh(new_warehouse, spark):
    """All 29 tables, in the catalog and in the files, and what happens when one type is another."""
    days = {"silver.ventas_clean": (), "gold.fact_ventas": (), "gold.fact_kpis_diarios": ()}
    warehouse = new_warehouse(partitions=days)
    run = pipeline.run(warehouse, TpchTables(spark, SMALL).source, COLUMNS, AS_OF, RUN_TS)
    assert len(run.rows) == len(TABLES) == 29
    assert warehouse.drift() == []
    name, path = warehouse.name("bronze.sucursales"), warehouse._folder(warehouse.spec("bronze.sucursales"))
    ddl = ", ".join(f"{c} {'STRING' if c == 'area_metros' else k}" for c, k in TABLES["bronze.sucursales"].columns)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet LOCATION '{path}/other'")
    assert warehouse.drift() == [("bronze.sucursales", "area_metros", "decimal(10,2)", "string")]
    spark.sql(f"DROP TABLE {name}")
    assert warehouse.drift() == [("bronze.sucursales", "", "table", None)]
    warehouse.create()
    warehouse.read("bronze.sucursales").withColumn("id", F.lit("1")).write.parquet(f"{path}/text")
    spark.createDataFrame([("1",)], "id string").write.mode("overwrite").parquet(f"{path}/text")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}/text'")
    assert ("bronze.sucursales", "id", "bigint", "string") in warehouse.drift()


def test_ambiguous_upsert_leaves_the_table_as_it_was(new_warehouse, stock):
    warehouse = new_warehouse()
    warehouse.overwrite(STOCK, stock([(1, 10, 5)]))
    with pytest.raises(AmbiguousUpdate):
        warehouse.upsert(STOCK, stock([(1, 10, 6), (1, 10, 7)]), ["sucursal_id", "inventario_id"])
    assert quantities(warehouse) == [(1, 10, 5)]


def test_upsert_of_daily_kpis(new_warehouse, kpis):
    days = [dt.date(2001, 8, day) for day in (1, 2, 3)]
    warehouse = new_warehouse()
    warehouse.overwrite(KPIS, kpis([(days[0], 1, 10), (days[1], 1, 20), (days[1], 2, 21)]))
    warehouse.upsert(KPIS, kpis([(days[1], 1, 99), (days[2], 1, 30)]), ["fecha_key", "sucursal_key"])
    rows = warehouse.read(KPIS).select("fecha_key", "sucursal_key", F.col("ventas_totales").cast("int")).collect()
    assert sorted(map(tuple, rows)) == [(days[0], 1, 10), (days[1], 1, 99), (days[1], 2, 21), (days[2], 1, 30)]


def lines_frame(spark, count, files):
    ids = spark.range(0, count, 1, files)
    return ids.select(
        F.col("id").alias("detalle_id"),
        (F.col("id") * 7919 % 1000).alias("venta_id"),
        (F.col("id") * 104729 % 997).alias("producto_id"),
        F.lit(1).alias("cantidad"),
        F.lit(2).alias("precio_unitario"),
        F.lit(2).alias("subtotal"),
    )


def test_a_partition_that_holds_everything_is_written_by_several_tasks(new_warehouse, spark):
    ids = spark.range(0, 40_000, 1, 8)
    lots = ids.select(
        F.col("id").alias("inventario_id"),
        F.hash("id").alias("producto_id"),
        F.when(F.col("id") % 100 == 0, F.col("id") % 7).otherwise(3).alias("sucursal_id"),
        F.lit(1).alias("cantidad"),
        F.current_timestamp().alias("fecha_actualizacion"),
        F.lit(None).alias("fecha_caducidad"),
        F.lit(999).alias("dias_hasta_caducidad"),
        F.lit("Optimo").alias("estado_caducidad"),
        F.lit("Stock OK").alias("alerta_stock"),
    )
    warehouse = new_warehouse()
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        assert warehouse.overwrite(STOCK, lots) == 40_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = rows_by_file(warehouse, STOCK).filter("sucursal_id = 3").groupBy("file").count()
    assert hot.count() >= 4 and hot.agg(F.max("count")).first()[0] < 20_000
    assert rows_by_file(warehouse, STOCK).filter("sucursal_id = 5").select("file").distinct().count() == 1


def test_measured_size_does_not_outlive_the_files(new_warehouse, spark, stock):
    """A size kept from smaller files could make Spark broadcast a large table."""

    def believed(warehouse, table):
        plan = warehouse.spark.table(warehouse.name(table))._jdf.queryExecution().optimizedPlan()
        return int(plan.stats().sizeInBytes())

    warehouse = new_warehouse()
    warehouse.overwrite(LINES, lines_frame(spark, 10, 1), RUN_TS)
    small = believed(warehouse, LINES)
    warehouse.overwrite(LINES, lines_frame(spark, 40_000, 4), RUN_TS)
    assert believed(warehouse, LINES) > 10 * small
    warehouse.overwrite(STOCK, stock([(1, 1, 1)]))
    small = believed(warehouse, STOCK)
    many = [(n, 1, n % 7) for n in range(20_000)]
    warehouse.upsert(STOCK, stock(many), ["sucursal_id", "inventario_id"])
    assert believed(warehouse, STOCK) > 5 * small


def test_share_holds_only_the_two_marts(new_warehouse, kpis, tmp_path, spark):
    warehouse = new_warehouse()
    warehouse.overwrite(KPIS, kpis([(dt.date(2001, 8, 1), 1, 10), (dt.date(2001, 8, 2), 1, 10)]))
    branch = spark.createDataFrame([(1, 5, Decimal(1), Decimal(1), 1, 0, 0, 0, 0, 9.5)], GOLD["fact_kpis_inventario"])
    warehouse.overwrite("gold.fact_kpis_inventario", branch)
    target = str(tmp_path / "share")
    manifest = {row.tabla: row.filas for row in publish(warehouse, target, RUN_TS).collect()}
    assert manifest == {KPIS: 2, "gold.fact_kpis_inventario": 1}
    warehouse.overwrite(KPIS, kpis([(dt.date(2001, 8, 3), 1, 10)]))
    before = shared(spark, target, KPIS)
    assert before.count() == 2
    assert spark.read.parquet(f"{target}/manifest").count() == 2
    publish(warehouse, target, RUN_TS + dt.timedelta(hours=1))
    assert [row.fecha_key for row in shared(spark, target, KPIS).collect()] == [dt.date(2001, 8, 3)]
    assert before.count() == 2, "who reads the first copy keeps it"
    with pytest.raises(LookupError):
        shared(spark, target, "gold.fact_ventas")
    copy = spark.read.parquet(f"{target}/manifest").filter(F.col("tabla") == KPIS).orderBy(F.desc("publicado")).first().ruta
    spark.read.parquet(copy).withColumn("numero_transacciones", F.lit(2).cast("long")).write.parquet(f"{copy}-other")
    spark.read.parquet(f"{copy}-other").write.mode("overwrite").parquet(copy)
    with pytest.raises(ContentMismatch):
        shared(spark, target, KPIS)


def test_stored_files_are_zstd_whatever_the_session_writes(new_warehouse, stock, kpis, spark):
    warehouse = new_warehouse()
    plain, day = "silver.detalle_ventas_clean", dt.date(2001, 7, 1)
    warehouse.overwrite(plain, lines_frame(spark, 10, 1))
    warehouse.overwrite(STOCK, stock([(1, 10, 5)]))
    warehouse.overwrite("gold.fact_kpis_diarios", kpis([(day, 1, 5)]))
    warehouse.upsert("gold.fact_kpis_diarios", kpis([(day, 1, 6)]), ["fecha_key", "sucursal_key"])
    for table in (plain, STOCK, "gold.fact_kpis_diarios"):
        files = rows_by_file(warehouse, table).select("file").distinct().collect()
        assert files and all(row.file.endswith(".zstd.parquet") for row in files), table
