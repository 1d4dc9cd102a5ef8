from __future__ import annotations

import pytest
from conftest import AS_OF, RUN_TS, SMALL
from pyspark.sql import functions as F

from bodega.contract import registry
from bodega.plans import ingest, pipeline
from bodega.schemas import SYNC_STAMP
from bodega.sources.tpch import COLUMNS, TpchTables

# The test data has a handful of sales per day: a folder per day would be all files and no rows.
PLAIN = {"silver.ventas_clean": (), "gold.fact_ventas": (), "gold.fact_kpis_diarios": ()}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    from bodega.sinks.warehouse import Warehouse

    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("lake")), "pipeline_", PLAIN)
    run = pipeline.run(warehouse, TpchTables(spark, SMALL).source, COLUMNS, AS_OF, RUN_TS)
    return warehouse, run


def test_every_table_is_filled(lake):
    warehouse, run = lake
    assert run.rows["silver.ventas_clean"] == run.rows["gold.fact_ventas"] == 493
    assert run.rows["gold.dim_tiempo"] == 731
    for table, rows in run.rows.items():
        assert warehouse.read(table).count() == rows, table
    assert len(run.rows) == 12 + 6 + 11


def test_rows_of_every_step_are_counted_during_the_writes(lake, spark):
    warehouse, run = lake
    counts = {(row.capa, row.tabla, row.regla): (row.filas_entrada, row.filas_validas) for row in run.counts.report(spark).collect()}
    lines = warehouse.read("bronze.detalle_ventas")
    valid = lines.filter("cantidad > 0 AND precio_unitario > 0 AND subtotal > 0")
    unique = valid.select("id").distinct().count()
    assert counts["silver", "detalle_ventas", "todas"] == (lines.count(), valid.count())
    assert counts["silver", "detalle_ventas", "unicas"] == (unique, unique)
    kept = warehouse.read("silver.detalle_ventas_clean").count()
    assert counts["silver", "detalle_ventas", "conciliadas"] == (unique, kept) and kept < unique
    for table, rows in run.rows.items():
        assert counts[(*table.split("."), "escritas")] == (rows, rows)
    assert counts["bronze", "productos_erp", "escritas"][0] == warehouse.read("bronze.productos_erp").count()
    assert len(counts) == 12 + 12 + 6 + 6 + 1 + 6 + 11


def test_day_parts_add_up_to_the_total(lake):
    parts = F.col("ventas_manana") + F.col("ventas_tarde") + F.col("ventas_noche")
    assert lake[0].read("gold.fact_kpis_diarios").filter(parts != F.col("ventas_totales")).isEmpty()


def test_kpis_and_sales_have_the_same_totals(lake):
    kpis = lake[0].read("gold.fact_kpis_diarios").agg(F.sum("ventas_totales"), F.sum("numero_transacciones")).first()
    sales = lake[0].read("gold.fact_ventas").agg(F.sum("total"), F.count("*")).first()
    assert tuple(kpis) == tuple(sales)


def test_alerts_are_the_lots_that_need_action(lake):
    alerts = lake[0].read("gold.fact_alertas_inventario").select("inventario_id")
    needed = lake[0].read("gold.fact_inventario").filter("requiere_accion").select("inventario_id")
    assert alerts.exceptAll(needed).isEmpty() and needed.exceptAll(alerts).isEmpty()
    assert lake[0].read("gold.fact_alertas_inventario").filter("prioridad = 'Baja'").isEmpty()


def test_a_second_run_gives_the_same_tables(lake, spark):
    warehouse, run = lake
    tables = ["gold.fact_kpis_diarios", "gold.fact_analisis_clientes", "silver.detalle_ventas_clean"]
    before = {table: sorted(map(repr, warehouse.read(table).collect())) for table in tables}
    again = pipeline.run(warehouse, TpchTables(spark, SMALL).source, COLUMNS, AS_OF, RUN_TS)
    assert again.rows == run.rows
    assert {table: sorted(map(repr, warehouse.read(table).collect())) for table in tables} == before


def test_one_failing_source_does_not_stop_the_others(new_warehouse, spark):
    tables = TpchTables(spark, SMALL)

    def read(table):
        if table == "productos":
            raise ConnectionError("source is down")
        return tables.source(table)

    warehouse = new_warehouse()
    results = ingest.load_all(warehouse, read, ["sucursales", "productos", "proveedores"], RUN_TS)
    assert ingest.status(results) == "PARTIAL: 2/3"
    rows = {row.tabla: (row.filas, row.ok, row.error) for row in ingest.summary(spark, results).collect()}
    assert rows == {
        "sucursales": (25, True, None),
        "productos": (0, False, "source is down"),
        "proveedores": (10, True, None),
    }
    run = pipeline.Run(AS_OF, RUN_TS)
    with pytest.raises(pipeline.PartialIngest, match="productos: source is down"):
        pipeline.to_bronze(warehouse, read, ["sucursales", "productos"], run)
    pipeline.to_bronze(warehouse, read, ["sucursales", "productos"], run, allow_partial=True)
    assert ingest.status(ingest.load_all(warehouse, tables.source, ["sucursales"], RUN_TS)) == "SUCCESS"


def test_stale_audit_column_is_replaced(new_warehouse, spark):
    warehouse = new_warehouse()
    stale = TpchTables(spark, SMALL).source("sucursales").withColumn(SYNC_STAMP, F.lit("1999-01-01"))
    assert ingest.load(warehouse, lambda _: stale, "sucursales", RUN_TS).ok
    stamps = warehouse.read("bronze.sucursales").select(SYNC_STAMP).distinct().collect()
    assert [row[0] for row in stamps] == [RUN_TS]


def test_a_call_reads_what_the_folder_holds_now(spark, tmp_path):
    """A refresh kept from an earlier call would cost nothing and show old rows."""
    tables = TpchTables(spark, SMALL)
    for name in ("customer", "nation", "part", "region", "supplier", "orders", "lineitem"):
        tables.raw(name).limit(25).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")

    def stored_sales():
        report = registry.queries()["quality_report"](spark, str(tmp_path))
        return report.filter("capa = 'bronze' AND tabla = 'ventas' AND regla = 'escritas'").first().filas_validas

    assert stored_sales() == 25
    tables.raw("orders").limit(40).coalesce(1).write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    assert stored_sales() == 65


def test_a_reader_of_all_tables_adds_the_purchases_up_once(spark):
    tables = TpchTables(spark, SMALL)
    for table in ("ordenes_compra", "recepciones"):
        read = tables.source_of_all(table)
        plan = read._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan and "lineitem" not in plan
        assert read.schema == tables.source(table).schema
        assert sorted(map(repr, read.collect())) == sorted(map(repr, tables.source(table).collect()))
    assert read.inputFiles() and set(read.inputFiles()) == set(tables.source_of_all("ordenes_compra").inputFiles())


def test_the_refresh_reads_the_purchases_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pipeline, "run", lambda warehouse, read, tables, *_: seen.extend(read(table) for table in tables))
    registry._refresh(TpchTables(spark, SMALL))
    assert sum("lineitem.parquet" in "".join(df.inputFiles()) for df in seen) == 2  # lines and stock movements
