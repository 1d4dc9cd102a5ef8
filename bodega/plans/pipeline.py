"""The full refresh: sources to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from bodega.operators.quality import StepCounts
from bodega.plans import gold, ingest, silver
from bodega.session import each, materialise
from bodega.sinks.warehouse import Warehouse
from bodega.sources.calendar import days_between


class PartialIngest(RuntimeError):
    """Some source tables did not arrive."""


@dataclass
class Run:
    """When the data is looked at, how many rows each table got, and how many each step let through."""

    as_of: dt.date
    run_ts: dt.datetime
    rows: dict[str, int] = field(default_factory=dict)
    counts: StepCounts = field(default_factory=StepCounts)

    def wrote(self, table: str, rows: int) -> None:
        self.rows[table] = rows
        self.counts.written(*table.split("."), rows)


def to_bronze(
    warehouse: Warehouse, read: ingest.Reader, tables: Iterable[str], run: Run, allow_partial: bool = False
) -> list[ingest.Loaded]:
    results = ingest.load_all(warehouse, read, tables, run.run_ts)
    for result in results:
        if result.ok:
            run.wrote(f"bronze.{result.table}", result.rows)
    outcome = ingest.status(results)
    if outcome != "SUCCESS" and not allow_partial:
        failed = "; ".join(f"{result.table}: {result.error}" for result in results if not result.ok)
        raise PartialIngest(f"{outcome} ({failed})")
    return results


def to_silver(warehouse: Warehouse, run: Run) -> None:
    bronze = {name: warehouse.read(f"bronze.{name}") for name in silver.CHECKS}
    datasets = {
        "ventas_clean": silver.ventas(bronze["ventas"], run.counts),
        "detalle_ventas_clean": silver.detalle_ventas(bronze["detalle_ventas"], run.counts),
        "clientes_clean": silver.clientes(bronze["clientes"], run.as_of, run.counts),
        "productos_clean": silver.productos(bronze["productos"], run.counts),
        "proveedores_clean": silver.proveedores(bronze["proveedores"], run.counts),
        "inventario_clean": silver.inventario(bronze["inventario"], run.as_of, run.counts),
    }

    def store(name: str) -> None:
        run.wrote(f"silver.{name}", warehouse.overwrite(f"silver.{name}", datasets[name], run.run_ts))

    each(store, datasets)


def to_gold(warehouse: Warehouse, run: Run) -> None:
    """Dimensions, sales and stock side by side. A frame that several tables need is written once, unrounded."""
    names = ("clientes", "productos", "inventario", "ventas", "detalle_ventas")
    clean = {name: warehouse.read(f"silver.{name}_clean") for name in names}

    def store(name: str, df: DataFrame) -> None:
        run.wrote(f"gold.{name}", warehouse.overwrite(f"gold.{name}", df))

    def dimensions() -> None:
        days = days_between(warehouse.spark, gold.CALENDAR_START, gold.CALENDAR_END)
        store("dim_tiempo", gold.dim_tiempo(days))
        store("dim_clientes", gold.dim_clientes(clean["clientes"], run.run_ts))
        store("dim_productos", gold.dim_productos(clean["productos"], run.run_ts))
        store("dim_sucursales", gold.dim_sucursales(warehouse.read("bronze.sucursales"), run.run_ts))

    def sales() -> None:
        per_sale = gold.line_rollup(gold.lines_with_margin(clean["detalle_ventas"], clean["productos"]))
        fact = materialise(gold.fact_ventas(clean["ventas"], per_sale, run.run_ts), "fact_ventas")
        store("fact_ventas", fact)
        store("fact_kpis_diarios", gold.kpis_diarios(fact))
        store("fact_analisis_clientes", gold.analisis_clientes(fact, run.as_of))

    def products() -> None:
        performance = gold.rendimiento_productos(clean["detalle_ventas"], clean["productos"])
        store("fact_rendimiento_productos", performance)

    def stock() -> None:
        lots = gold.fact_inventario(clean["inventario"], clean["productos"], run.as_of, run.run_ts)
        store("fact_inventario", lots)
        # Stock values are exact at two places, so the stored table serves the KPIs and alerts as well.
        stored = warehouse.read("gold.fact_inventario")
        store("fact_kpis_inventario", gold.kpis_inventario(stored))
        store("fact_alertas_inventario", gold.alertas_inventario(stored, run.run_ts))

    each(lambda part: part(), (sales, products, stock, dimensions))


def run(
    warehouse: Warehouse,
    read: ingest.Reader,
    tables: Iterable[str],
    as_of: dt.date,
    run_ts: dt.datetime,
    allow_partial: bool = False,
) -> Run:
    """Refresh every table."""
    this = Run(as_of, run_ts)
    warehouse.create()
    to_bronze(warehouse, read, tables, this, allow_partial)
    to_silver(warehouse, this)
    to_gold(warehouse, this)
    return this
