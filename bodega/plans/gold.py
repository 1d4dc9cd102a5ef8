"""Star schema and marts. Functions take silver frames and give unrounded frames with the declared columns.

``stored`` rounds a frame to the declared types. The daily KPIs add up the unrounded sales frame, so their
margin can differ in the cents from the sum over the stored sales table.
"""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.functions import rules
from bodega.plans.silver import UNCLASSIFIED
from bodega.schemas import conform, declared

CALENDAR_START, CALENDAR_END = dt.date(2024, 1, 1), dt.date(2025, 12, 31)

CALENDAR_PARTS = {
    "anio": F.year,
    "mes": F.month,
    "dia": F.dayofmonth,
    "dia_semana": F.dayofweek,
    "semana_anio": F.weekofyear,
    "trimestre": F.quarter,
    "mes_nombre": partial(F.date_format, format="MMMM"),
    "dia_semana_nombre": partial(F.date_format, format="EEEE"),
    "tipo_dia": rules.day_type,
    "temporada": rules.season,
}

KEYS = {"fecha_date": "fecha_key", "cliente_id": "cliente_key", "sucursal_id": "sucursal_key"}


def stored(df: DataFrame, table: str) -> DataFrame:
    return conform(df, f"gold.{table}")


def totals(**measures: str | Column) -> list[Column]:
    """One sum per measure: result name -> what is added up."""
    return [F.sum(source).alias(name) for name, source in measures.items()]


def matches(**measures: str | Column) -> list[Column]:
    """One count of rows per measure: result name -> the condition that counts."""
    return [F.count_if(condition).alias(name) for name, condition in measures.items()]


# --- dimensions ---


def dim_tiempo(days: DataFrame) -> DataFrame:
    """Calendar attributes for a frame with one ``fecha`` per row."""
    calendar = days.withColumnsRenamed({"fecha": "fecha_key"})
    return calendar.withColumns({name: part(F.col("fecha_key")) for name, part in CALENDAR_PARTS.items()})


def _dimension(df: DataFrame, table: str, renames: dict[str, str], run_ts: dt.datetime) -> DataFrame:
    stamped = df.withColumnsRenamed(renames).withColumn("fecha_actualizacion", rules.instant(run_ts))
    return declared(stamped, f"gold.{table}")


def dim_clientes(clientes: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return _dimension(clientes, "dim_clientes", {"cliente_id": "cliente_key"}, run_ts)


def dim_productos(productos: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """The supplier is always the unknown one, whatever silver has."""
    unknown = productos.withColumn("proveedor_id", F.lit(UNCLASSIFIED["proveedor_id"]))
    return _dimension(unknown, "dim_productos", {"producto_id": "producto_key", "nombre": "producto_nombre"}, run_ts)


def dim_sucursales(sucursales: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Straight from bronze: no filter and no dedup."""
    return _dimension(sucursales, "dim_sucursales", {"id": "sucursal_key", "nombre": "sucursal_nombre"}, run_ts)


# --- sales ---


def lines_with_margin(lines: DataFrame, productos: DataFrame) -> DataFrame:
    """Sale lines with their margin amount; an unknown product gives a NULL margin.

    ``productos`` should be a stored table. AQE cuts up a hot product only when both sides of the join come
    straight from their shuffles, and a dedup still in the plan would lend its partitioning to the join instead.
    """
    priced = lines.join(productos.select("producto_id", "margen"), "producto_id", "left")
    return priced.withColumn("margen_item", rules.percent_of(F.col("subtotal"), F.col("margen")))


def line_rollup(lines: DataFrame) -> DataFrame:
    """Per sale: quantity, margin, and the number of lines (called distinct items downstream)."""
    line_count = F.count("detalle_id").alias("num_items_distintos")
    return lines.groupBy("venta_id").agg(
        line_count, *totals(cantidad_total_items="cantidad", margen_total="margen_item")
    )


def fact_ventas(ventas: DataFrame, per_sale: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """One row per sale, with the measures of its ``line_rollup``; NULL measures for a sale without lines.

    Lines are added up before the join, so the join has one row per sale on both sides however many lines
    a sale has.
    """
    measured = ventas.withColumnsRenamed(KEYS).join(per_sale, "venta_id", "left")
    per_item = F.col("total") / F.col("num_items_distintos")
    computed = {"ticket_promedio_item": per_item, "fecha_carga": rules.instant(run_ts)}
    return declared(measured.withColumns(computed), "gold.fact_ventas")


def kpis_diarios(sales: DataFrame) -> DataFrame:
    """Per day and branch, from the unrounded sales frame. ``ventas_fin_semana`` counts transactions."""
    (morning, afternoon) = (name for _, _, name in rules.DAY_PARTS)

    def sold_in(part: str) -> Column:
        return F.when(F.col("periodo_dia") == part, F.col("total")).otherwise(0)

    day_parts = totals(
        ventas_manana=sold_in(morning), ventas_tarde=sold_in(afternoon), ventas_noche=sold_in(rules.NIGHT)
    )
    amounts = totals(ventas_totales="total", margen_bruto_total="margen_total", items_vendidos="cantidad_total_items")
    return sales.groupBy("fecha_key", "sucursal_key").agg(
        F.count("venta_id").alias("numero_transacciones"),
        F.count_distinct("cliente_key").alias("clientes_unicos"),
        F.avg("total").alias("ticket_promedio"),
        *amounts,
        *day_parts,
        *matches(ventas_fin_semana="es_fin_semana"),
    )


def analisis_clientes(sales: DataFrame, as_of: dt.date) -> DataFrame:
    """Recency, frequency, value and segment per customer; sales without a customer form one row."""
    per_customer = sales.groupBy("cliente_key").agg(
        F.count("venta_id").alias("frecuencia_compras"),
        F.max("fecha_key").alias("ultima_compra"),
        F.count_distinct("sucursal_key").alias("sucursales_visitadas"),
        F.avg("total").alias("ticket_promedio_cliente"),
        *totals(valor_total_compras="total", items_totales="cantidad_total_items"),
    )
    dated = per_customer.withColumn("recency_dias", rules.days_since(F.col("ultima_compra"), as_of))
    segment = rules.rfm_segment(F.col("recency_dias"), F.col("frecuencia_compras"), F.col("valor_total_compras"))
    return dated.withColumn("segmento_rfm", segment)


def rendimiento_productos(lines: DataFrame, productos: DataFrame) -> DataFrame:
    """Per product over all clean lines, those of unfinished sales included.

    The margin percentage is one number per product, so adding up subtotals first and applying the
    percentage afterwards is exact. Only one row per product reaches the join, and a product that holds
    a third of the lines is added up inside the map tasks.
    """
    per_product = lines.groupBy("producto_id").agg(
        *totals(unidades_vendidas="cantidad", ingresos_totales="subtotal"),
        F.count_distinct("venta_id").alias("transacciones_unicas"),
        F.count("venta_id").alias("numero_ventas"),
    )
    priced = per_product.join(productos.select("producto_id", "margen"), "producto_id", "left")
    margin = rules.percent_of(F.col("ingresos_totales"), F.col("margen"))
    return declared(priced.withColumn("margen_total", margin), "gold.fact_rendimiento_productos")


# --- stock ---


def fact_inventario(
    inventario: DataFrame, productos: DataFrame, as_of: dt.date, run_ts: dt.datetime
) -> DataFrame:
    """One row per stock lot, valued at cost and at sale price; NULL values for an unknown product.

    ``productos`` should be a stored table, as for ``lines_with_margin``.
    """
    lots = inventario.join(productos.select("producto_id", "precio", "costo"), "producto_id", "left")
    computed = {
        "valor_inventario": F.col("cantidad") * F.col("costo"),
        "valor_venta_potencial": F.col("cantidad") * F.col("precio"),
        "requiere_accion": rules.needs_action(F.col("estado_caducidad"), F.col("alerta_stock")),
        "fecha_key": F.lit(as_of),
        "fecha_carga": rules.instant(run_ts),
    }
    keyed = lots.withColumnsRenamed({**KEYS, "producto_id": "producto_key"})
    return declared(keyed.withColumns(computed), "gold.fact_inventario")


def kpis_inventario(stock: DataFrame) -> DataFrame:
    """Per branch. The average days to expiry includes the sentinel of goods that do not expire."""
    state, alert = F.col("estado_caducidad"), F.col("alerta_stock")
    critical, warning = rules.URGENT_STATES
    return stock.groupBy("sucursal_key").agg(
        *totals(
            stock_total="cantidad",
            valor_total_inventario="valor_inventario",
            valor_venta_potencial_total="valor_venta_potencial",
        ),
        *matches(
            items_unicos=F.col("inventario_id").isNotNull(),
            items_criticos=state == critical,
            items_alerta=state == warning,
            items_sin_stock=alert == rules.OUT_OF_STOCK,
            items_stock_bajo=alert == rules.LOW_STOCK,
        ),
        F.avg("dias_hasta_caducidad").alias("dias_promedio_caducidad"),
    )


def alertas_inventario(stock: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Lots that need action, with a priority and what to do."""
    state, alert = F.col("estado_caducidad"), F.col("alerta_stock")
    advice = {
        "prioridad": rules.priority(state, alert),
        "accion_recomendada": rules.recommended_action(F.col("dias_hasta_caducidad"), alert),
        "fecha_alerta": rules.instant(run_ts),
    }
    return declared(stock.filter("requiere_accion").withColumns(advice), "gold.fact_alertas_inventario")
