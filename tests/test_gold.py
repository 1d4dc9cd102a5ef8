from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import AS_OF, RUN_TS, by_key

from bodega.plans import gold
from bodega.schemas import SILVER
from bodega.sources.calendar import days_between


@pytest.fixture
def silver_rows(spark):
    def make(table, rows):
        return spark.createDataFrame(rows, SILVER[table])

    return make


@pytest.fixture
def products(silver_rows):
    def product(number, margin, price="10.00", cost="8.00"):
        return (number, "p", "General", Decimal(price), Decimal(cost), 0, Decimal(margin), "Abarrotes")

    return silver_rows("productos_clean", [product(1, "20.00"), product(2, "33.33")])


@pytest.fixture
def lines(silver_rows):
    def line(number, sale, product, quantity, subtotal):
        return (number, sale, product, Decimal(quantity), Decimal("1.00"), Decimal(subtotal))

    return silver_rows(
        "detalle_ventas_clean",
        [
            line(1, 1, 1, "2.000", "10.00"),
            line(2, 1, 2, "0.350", "0.05"),
            line(3, 2, 99, "1.000", "5.00"),
            line(4, 99, 2, "4.000", "7.00"),
        ],
    )


@pytest.fixture
def sales(silver_rows):
    def sale(number, customer, branch, total, day, part, weekend):
        moment = dt.datetime.combine(day, dt.time(10))
        return (
            number, moment, customer, branch, Decimal(total), "completada", "x", day, 10, 4, weekend, part,
        )

    day = dt.date(2001, 8, 1)
    return silver_rows(
        "ventas_clean",
        [
            sale(1, 5, 1, "10.05", day, "Mañana", False),
            sale(2, 5, 1, "20.00", day, "Noche", True),
            sale(3, None, 1, "30.00", day, "Tarde", True),
            sale(4, None, 2, "1.00", dt.date(2001, 1, 1), "Tarde", False),
        ],
    )


@pytest.fixture
def fact(sales, lines, products):
    return gold.fact_ventas(sales, gold.line_rollup(gold.lines_with_margin(lines, products)), RUN_TS)


def test_sale_measures(fact):
    rows = by_key(gold.stored(fact, "fact_ventas"), "venta_id")
    assert (rows[1].cantidad_total_items, rows[1].num_items_distintos) == (Decimal("2.350"), 2)
    # 10.00 * 20 % + 0.05 * 33.33 % = 2.016665
    assert rows[1].margen_total == Decimal("2.02")
    assert rows[1].ticket_promedio_item == Decimal("5.03")  # 5.025, half up
    assert rows[2].margen_total is None and rows[2].num_items_distintos == 1
    assert rows[3].num_items_distintos is None and rows[3].ticket_promedio_item is None
    assert len(rows) == 4


def test_daily_kpis_use_the_unrounded_margin(fact):
    rows = by_key(gold.kpis_diarios(fact), "fecha_key")
    first = rows[dt.date(2001, 8, 1)]
    assert first.ventas_totales == Decimal("60.05") and first.numero_transacciones == 3
    assert first.margen_bruto_total == Decimal("2.016665")
    assert first.clientes_unicos == 1 and first.ventas_fin_semana == 2
    assert (first.ventas_manana, first.ventas_tarde, first.ventas_noche) == (
        Decimal("10.05"), Decimal("30.00"), Decimal("20.00"),
    )
    quiet = rows[dt.date(2001, 1, 1)]
    assert quiet.margen_bruto_total is None and quiet.items_vendidos is None and quiet.ventas_manana == 0


def test_sales_without_customer_are_one_group(fact):
    rows = by_key(gold.analisis_clientes(fact, AS_OF), "cliente_key")
    assert set(rows) == {5, None}
    assert (rows[None].frecuencia_compras, rows[None].sucursales_visitadas, rows[None].recency_dias) == (2, 2, 1)
    assert rows[None].segmento_rfm == "Regulares"


def test_product_performance_includes_lines_of_other_sales(lines, products):
    rows = by_key(gold.stored(gold.rendimiento_productos(lines, products), "fact_rendimiento_productos"), "producto_id")
    assert (rows[2].unidades_vendidas, rows[2].ingresos_totales) == (Decimal("4.350"), Decimal("7.05"))
    assert rows[2].margen_total == Decimal("2.35") and rows[2].transacciones_unicas == 2
    assert rows[99].margen_total is None and rows[99].ingresos_totales == Decimal("5.00")


def test_margin_after_summing_equals_summed_margin(lines, products):
    per_line = gold.lines_with_margin(lines, products).groupBy("producto_id").sum("margen_item")
    expected = {row.producto_id: row[1] for row in per_line.collect()}
    found = {r.producto_id: r.margen_total for r in gold.rendimiento_productos(lines, products).collect()}
    assert found == expected


@pytest.fixture
def stock(silver_rows, products):
    def lot(number, product, branch, quantity, days, state, alert):
        return (number, product, branch, quantity, RUN_TS, None, days, state, alert)

    lots = silver_rows(
        "inventario_clean",
        [
            lot(1, 1, 1, 3, 5, "Critico", "Stock Bajo"),
            lot(2, 2, 1, 0, 999, "Optimo", "Sin Stock"),
            lot(3, 99, 1, 50, 20, "Alerta", "Stock OK"),
            lot(4, 1, 1, 5, 100, "Optimo", "Stock Bajo"),
            lot(5, 1, 2, 50, 999, "Optimo", "Stock OK"),
        ],
    )
    return gold.fact_inventario(lots, products, AS_OF, RUN_TS)


def test_stock_values(stock):
    rows = by_key(gold.stored(stock, "fact_inventario"), "inventario_id")
    assert (rows[1].valor_inventario, rows[1].valor_venta_potencial) == (Decimal("24.00"), Decimal("30.00"))
    assert rows[3].valor_inventario is None
    assert [rows[n].requiere_accion for n in range(1, 6)] == [True, True, True, False, False]
    assert rows[1].fecha_key == AS_OF


def test_stock_kpis(stock):
    rows = by_key(gold.stored(gold.kpis_inventario(stock), "fact_kpis_inventario"), "sucursal_key")
    busy = rows[1]
    assert (busy.stock_total, busy.items_unicos, busy.valor_total_inventario) == (58, 4, Decimal("64.00"))
    assert (busy.items_criticos, busy.items_alerta, busy.items_sin_stock, busy.items_stock_bajo) == (1, 1, 1, 2)
    assert busy.dias_promedio_caducidad == (5 + 999 + 20 + 100) / 4


def test_stock_alerts(stock):
    rows = by_key(gold.stored(gold.alertas_inventario(stock, RUN_TS), "fact_alertas_inventario"), "inventario_id")
    found = {number: (row.prioridad, row.accion_recomendada) for number, row in rows.items()}
    assert found == {
        1: ("Alta", "Liquidar urgente"),
        2: ("Alta", "Reabastecer urgente"),
        3: ("Media", "Monitorear"),
    }


def test_calendar_has_every_day_once(spark):
    days = gold.dim_tiempo(days_between(spark, gold.CALENDAR_START, gold.CALENDAR_END))
    rows = by_key(gold.stored(days, "dim_tiempo"), "fecha_key")
    assert len(rows) == 731 and days.count() == 731
    newyear = rows[dt.date(2024, 12, 30)]
    assert (newyear.semana_anio, newyear.mes_nombre, newyear.dia_semana_nombre) == (1, "December", "Monday")
    assert (newyear.trimestre, newyear.temporada, newyear.tipo_dia) == (4, "Alta", "Entre Semana")


def test_dimensions(silver_rows, products, bronze):
    rows = by_key(gold.stored(gold.dim_productos(products, RUN_TS), "dim_productos"), "producto_key")
    assert rows[2].margen == Decimal("33.33") and rows[2].proveedor_id == 0 and rows[2].fecha_actualizacion == RUN_TS
    customers = silver_rows(
        "clientes_clean", [(1, "n", "e", "t", "c", RUN_TS, "VIP", 10, "Nuevo", 3)]
    )
    (row,) = gold.stored(gold.dim_clientes(customers, RUN_TS), "dim_clientes").collect()
    assert (row.cliente_key, row.nivel_credito_num, row.fecha_registro) == (1, 3, RUN_TS)
    branches = bronze("sucursales", [{"id": 1, "nombre": "s"}, {"id": 1, "nombre": "s"}])
    assert gold.stored(gold.dim_sucursales(branches, RUN_TS), "dim_sucursales").count() == 2
