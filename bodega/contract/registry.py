"""The registered queries: each takes a session and a folder of parquet tables and gives a frame.

All of them start from the folder's tables. Dates leave as ISO text and decimals as text with all their places, because
the two engines under comparison hand those types to Python in different forms.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bodega.operators.dedup import one_per_key
from bodega.plans import gold, ingest, pipeline, reports, silver
from bodega.schemas import SYNC_STAMP
from bodega.session import materialise, scratch_path
from bodega.sinks.share import SHARED_TABLES, publish, shared
from bodega.sinks.warehouse import Warehouse
from bodega.sources.calendar import days_covering
from bodega.sources.tpch import AS_OF, COLUMNS, RUN_TS, TpchTables

Query = Callable[[SparkSession, str], DataFrame]

NATIONS = tuple(f"NATION_{number}" for number in (1, 3, 5, 8, 13, 21))
PRIORITY_AFTER, PRIORITY_BEFORE = dt.date(1996, 1, 1), dt.date(1998, 7, 1)
RESTATED_FROM = dt.date(2001, 7, 1)
# The source that does not answer in the ingest report.
DOWN, DOWN_REASON = "recepciones", "source is down"

_registered: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Decimals and dates as text, session timestamps as plain ones."""

    as_sql = {"date": "CAST(`{0}` AS STRING)", "timestamp": "CAST(`{0}` AS TIMESTAMP_NTZ)"}

    def column(name: str, kind: str) -> str:
        form = "CAST(`{0}` AS STRING)" if kind.startswith("decimal") else as_sql.get(kind, "`{0}`")
        return f"{form.format(name)} AS `{name}`"

    return df.selectExpr(*[column(name, kind) for name, kind in df.dtypes])


def registered(query: Callable[[TpchTables], DataFrame]) -> Callable[[TpchTables], DataFrame]:
    """Register a function of the tables under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(query(TpchTables(spark, folder)))

    _registered[query.__name__] = run
    return query


def queries() -> dict[str, Query]:
    return dict(_registered)


def _stored(df: DataFrame, table: str) -> DataFrame:
    """Gold rows as stored, load time included."""
    return gold.stored(df, table)


def _scratch_warehouse(tables: TpchTables, label: str) -> Warehouse:
    """A warehouse of its own in the shared folder, with database names no other run uses."""
    root = scratch_path(tables.spark, label)
    return Warehouse(tables.spark, root, f"run_{root[-32:]}_")


# --- reports straight over the tables ---


@registered
def bi_orders_customers(t: TpchTables) -> DataFrame:
    return reports.orders_customers(t.raw("orders"))


@registered
def bi_returns(t: TpchTables) -> DataFrame:
    return reports.returns(t.raw("lineitem"))


@registered
def bi_supplier_count(t: TpchTables) -> DataFrame:
    return reports.supplier_count(t.raw("supplier"))


@registered
def bi_orders_by_priority(t: TpchTables) -> DataFrame:
    return reports.orders_by_priority(t.raw("orders"), t.raw("lineitem"), mode="l_linestatus")


@registered
def bi_revenue_by_nation(t: TpchTables) -> DataFrame:
    lineitem = t.money("lineitem", l_extendedprice="decimal(12,2)", l_discount="decimal(4,2)")
    result = reports.revenue_by_nation(t.raw("customer"), t.raw("orders"), lineitem, t.raw("nation"), NATIONS)
    return result.withColumn("revenue", F.col("revenue").cast("decimal(28,2)"))


@registered
def bi_revenue_by_priority(t: TpchTables) -> DataFrame:
    return reports.revenue_by_priority(
        t.money("orders", o_totalprice="decimal(18,2)"), PRIORITY_AFTER, PRIORITY_BEFORE
    )


@registered
def bi_top_customers(t: TpchTables) -> DataFrame:
    return reports.top_customers(t.money("orders", o_totalprice="decimal(18,2)"), t.raw("customer"), t.raw("region"))


@registered
def events_periodo(t: TpchTables) -> DataFrame:
    return reports.events_by_period(t.raw("events"))


# --- bronze ---


def _ingested(t: TpchTables, table: str, read: ingest.Reader | None = None) -> DataFrame:
    """A bronze table read by name after its ingest, with every declared column."""
    warehouse = _scratch_warehouse(t, "ingest")
    ingest.load(warehouse, read or t.source, table, RUN_TS)
    return warehouse.read(f"bronze.{table}")


@registered
def bronze_scan(t: TpchTables) -> DataFrame:
    return _ingested(t, "ventas")


@registered
def bronze_audit_stamp(t: TpchTables) -> DataFrame:
    return _ingested(t, "proveedores")


@registered
def ingest_replace_audit_col(t: TpchTables) -> DataFrame:
    """A source that already carries an audit column gets a fresh one instead of a second one."""
    stale = t.source("clientes").withColumn(SYNC_STAMP, F.lit(dt.datetime(1999, 1, 1)))
    return _ingested(t, "clientes", lambda _: stale)


@registered
def ingest_summary(t: TpchTables) -> DataFrame:
    """All twelve tables, one of whose sources does not answer."""

    def read(table: str) -> DataFrame:
        if table == DOWN:
            raise ConnectionError(DOWN_REASON)
        return t.source(table)

    return ingest.summary(t.spark, ingest.load_all(_scratch_warehouse(t, "ingest"), read, COLUMNS, RUN_TS))


# --- silver ---


@registered
def dedup_detalle(t: TpchTables) -> DataFrame:
    lines = t.source("detalle_ventas").select(*COLUMNS["detalle_ventas"])
    return one_per_key(lines, ["id"])


@registered
def silver_ventas(t: TpchTables) -> DataFrame:
    return silver.ventas(t.bronze("ventas"))


@registered
def silver_detalle(t: TpchTables) -> DataFrame:
    return silver.detalle_ventas(t.bronze("detalle_ventas"))


@registered
def silver_clientes(t: TpchTables) -> DataFrame:
    return silver.clientes(t.bronze("clientes"), AS_OF)


@registered
def silver_productos(t: TpchTables) -> DataFrame:
    return silver.productos(t.bronze("productos"))


@registered
def silver_proveedores(t: TpchTables) -> DataFrame:
    return silver.proveedores(t.bronze("proveedores"))


@registered
def silver_inventario(t: TpchTables) -> DataFrame:
    return silver.inventario(t.bronze("inventario"), AS_OF)


def _refresh(t: TpchTables) -> tuple[Warehouse, pipeline.Run]:
    """The stored tables of a full refresh from what the folder holds now: what a dashboard reads."""
    warehouse = _scratch_warehouse(t, "lake")
    return warehouse, pipeline.run(warehouse, t.source_of_all, COLUMNS, AS_OF, RUN_TS)


@registered
def quality_report(t: TpchTables) -> DataFrame:
    """The row counts that a full refresh took down while it wrote."""
    return _refresh(t)[1].counts.report(t.spark)


# --- gold ---


@registered
def dim_tiempo(t: TpchTables) -> DataFrame:
    """The calendar over the days on which the tables have orders."""
    return _stored(gold.dim_tiempo(days_covering(t.raw("orders"), "o_orderdate")), "dim_tiempo")


@registered
def dim_clientes(t: TpchTables) -> DataFrame:
    return _stored(gold.dim_clientes(silver_clientes(t), RUN_TS), "dim_clientes")


@registered
def dim_productos(t: TpchTables) -> DataFrame:
    return _stored(gold.dim_productos(silver_productos(t), RUN_TS), "dim_productos")


@registered
def dim_sucursales(t: TpchTables) -> DataFrame:
    return _stored(gold.dim_sucursales(t.bronze("sucursales"), RUN_TS), "dim_sucursales")


def _products(t: TpchTables) -> DataFrame:
    """Clean products as a written table, which is what the lookups of gold expect."""
    return materialise(silver_productos(t), "productos")


def _lines(t: TpchTables) -> DataFrame:
    return gold.lines_with_margin(silver_detalle(t), _products(t))


def _sales(t: TpchTables) -> DataFrame:
    return gold.fact_ventas(silver_ventas(t), gold.line_rollup(_lines(t)), RUN_TS)


def _stock(t: TpchTables) -> DataFrame:
    return gold.fact_inventario(silver_inventario(t), _products(t), AS_OF, RUN_TS)


@registered
def detalle_enriquecido(t: TpchTables) -> DataFrame:
    return _lines(t).withColumn("margen_item", F.col("margen_item").cast("decimal(28,6)"))


@registered
def venta_line_rollup(t: TpchTables) -> DataFrame:
    return gold.line_rollup(_lines(t)).withColumn("margen_total", F.col("margen_total").cast("decimal(28,6)"))


@registered
def fact_ventas(t: TpchTables) -> DataFrame:
    return _stored(_sales(t), "fact_ventas")


@registered
def kpis_diarios(t: TpchTables) -> DataFrame:
    return _stored(gold.kpis_diarios(_sales(t)), "fact_kpis_diarios")


@registered
def rfm_clientes(t: TpchTables) -> DataFrame:
    return _stored(gold.analisis_clientes(_sales(t), AS_OF), "fact_analisis_clientes")


@registered
def rendimiento_productos(t: TpchTables) -> DataFrame:
    return _stored(gold.rendimiento_productos(silver_detalle(t), silver_productos(t)), "fact_rendimiento_productos")


@registered
def fact_inventario(t: TpchTables) -> DataFrame:
    return _stored(_stock(t), "fact_inventario")


@registered
def kpis_inventario(t: TpchTables) -> DataFrame:
    return _stored(gold.kpis_inventario(_stock(t)), "fact_kpis_inventario")


@registered
def alertas_inventario(t: TpchTables) -> DataFrame:
    return _stored(gold.alertas_inventario(_stock(t), RUN_TS), "fact_alertas_inventario")


# --- tiles and quick looks ---


def _mart(t: TpchTables, name: str) -> DataFrame:
    return _refresh(t)[0].read(f"gold.{name}")


@registered
def tile_weekly_dayparts(t: TpchTables) -> DataFrame:
    return reports.weekly_dayparts(_mart(t, "fact_kpis_diarios"))


@registered
def tile_daily_transactions(t: TpchTables) -> DataFrame:
    return reports.daily_transactions(_mart(t, "fact_kpis_diarios"))


@registered
def tile_items_by_period(t: TpchTables) -> DataFrame:
    return reports.items_by_period(_mart(t, "fact_ventas"))


@registered
def tile_total_revenue(t: TpchTables) -> DataFrame:
    return reports.total_revenue(_mart(t, "fact_rendimiento_productos"))


@registered
def recent_daily_sales(t: TpchTables) -> DataFrame:
    return reports.recent_daily_sales(t.bronze("ventas"))


@registered
def recent_purchase_orders(t: TpchTables) -> DataFrame:
    return reports.recent_purchase_orders(t.bronze("ordenes_compra"))


@registered
def active_branch_count(t: TpchTables) -> DataFrame:
    return reports.active_branch_count(t.bronze("sucursales"))


@registered
def active_supplier_count(t: TpchTables) -> DataFrame:
    return reports.active_supplier_count(t.bronze("proveedores"))


# --- writes ---


@registered
def upsert_clientes(t: TpchTables) -> DataFrame:
    """VIP customers move to a new level; customers rejected for a missing address arrive with one."""
    bronze = t.bronze("clientes")
    promoted = bronze.filter("tipo_cliente = 'VIP'").withColumn("tipo_cliente", F.lit("Platino"))
    completed = bronze.filter("email IS NULL").withColumn(
        "email", F.concat(F.lower("nombre"), F.lit("@nuevo.example.com"))
    )
    warehouse = _scratch_warehouse(t, "upsert")
    table = "silver.clientes_clean"
    warehouse.overwrite(table, silver.clientes(bronze, AS_OF), RUN_TS)
    batch = silver.clientes(promoted.unionByName(completed), AS_OF)
    warehouse.upsert(table, batch, ["cliente_id"], RUN_TS)
    return warehouse.read(table)


@registered
def upsert_kpis_diarios(t: TpchTables) -> DataFrame:
    """The latest days are restated with pending sales counted as completed."""
    warehouse = _scratch_warehouse(t, "upsert")
    table = "gold.fact_kpis_diarios"
    per_sale = materialise(gold.line_rollup(_lines(t)), "line_rollup")

    def kpis(bronze: DataFrame) -> DataFrame:
        return gold.kpis_diarios(gold.fact_ventas(silver.ventas(bronze), per_sale, RUN_TS))

    sales = t.bronze("ventas")
    late = sales.filter(F.col("fecha_hora") >= F.lit(RESTATED_FROM).cast("timestamp"))
    restated = late.filter("estatus <> 'cancelada'").withColumn("estatus", F.lit(silver.COMPLETED))
    warehouse.overwrite(table, kpis(sales))
    warehouse.upsert(table, kpis(restated), ["fecha_key", "sucursal_key"])
    return warehouse.read(table)


@registered
def publish_kpi_share(t: TpchTables) -> DataFrame:
    """Two publications, the first with the latest days only; the shared rows of both marts are those of the second."""
    lake, _ = _refresh(t)
    early = _scratch_warehouse(t, "share")
    late = F.col("fecha_key") >= F.lit(RESTATED_FROM)
    early.overwrite("gold.fact_kpis_diarios", lake.read("gold.fact_kpis_diarios").filter(late))
    early.overwrite("gold.fact_kpis_inventario", lake.read("gold.fact_kpis_inventario").limit(1))
    target = f"{early.root}/share"
    publish(early, target, RUN_TS - dt.timedelta(hours=8))
    publish(lake, target, RUN_TS)
    days, branches = (shared(t.spark, target, table).withColumn("tabla", F.lit(table)) for table in SHARED_TABLES)
    return days.unionByName(branches, allowMissingColumns=True)
