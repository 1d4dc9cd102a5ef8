from __future__ import annotations

import datetime as dt
from decimal import Decimal

from conftest import AS_OF, by_key
from pyspark.sql import functions as F

from bodega.operators import quality
from bodega.operators.dedup import one_per_key
from bodega.plans import silver
from bodega.schemas import SYNC_STAMP


def sale(number, **changes):
    row = {
        "id": number,
        "fecha_hora": dt.datetime(2001, 8, 1, 10),
        "cliente_id": 1,
        "sucursal_id": 1,
        "total": Decimal("10.00"),
        "estatus": "completada",
        "metodo_pago": "efectivo",
    }
    return {**row, **changes}


def line(number, quantity, price, subtotal, **changes):
    row = {"id": number, "venta_id": 1, "producto_id": 1, "cantidad": Decimal(quantity)}
    return {**row, "precio_unitario": Decimal(price), "subtotal": Decimal(subtotal), **changes}


def test_ventas_rejects_incomplete_rows(bronze):
    rows = [
        sale(1),
        sale(2, total=Decimal("0.00")),
        sale(3, total=Decimal("-1.00")),
        sale(4, total=None),
        sale(5, estatus="Completada"),
        sale(6, estatus=None),
        sale(7, fecha_hora=None),
        sale(8, cliente_id=None),
        sale(9, fecha_hora=dt.datetime(2001, 8, 4, 23, 59)),
    ]
    kept = by_key(silver.ventas(bronze("ventas", rows)), "venta_id")
    assert sorted(kept) == [1, 8, 9]
    assert (kept[1].hora, kept[1].dia_semana, kept[1].es_fin_semana, kept[1].periodo_dia) == (10, 4, False, "Mañana")
    saturday = kept[9]
    assert (saturday.fecha_date, saturday.dia_semana, saturday.es_fin_semana) == (dt.date(2001, 8, 4), 7, True)
    assert saturday.periodo_dia == "Noche"
    assert kept[8].cliente_id is None


def test_filters_run_before_dedup(bronze):
    rows = [sale(1, total=Decimal("0.00"), metodo_pago="a"), sale(1, metodo_pago="b")]
    (kept,) = silver.ventas(bronze("ventas", rows)).collect()
    assert kept.metodo_pago == "b"


def test_reconciliation_limit_is_exclusive(bronze):
    rows = [
        line(1, "2", "5.00", "10.99"),
        line(2, "2", "5.00", "11.00"),
        line(3, "2", "5.00", "11.01"),
        line(4, "2", "5.00", "9.01"),
        line(5, "0.350", "10.00", "3.50"),
        line(6, "0", "5.00", "0.50"),
        line(7, "1", "0.00", "0.50"),
        line(8, "1", "0.50", "0.00"),
        line(9, "-1", "5.00", "5.00"),
    ]
    kept = by_key(silver.detalle_ventas(bronze("detalle_ventas", rows)), "detalle_id")
    assert sorted(kept) == [1, 4, 5]
    assert kept[5].cantidad == Decimal("0.350")


def test_dedup_runs_before_reconciliation(bronze):
    """The smaller copy survives the dedup and then fails, although the other copy would have passed."""
    rows = [line(1, "2", "5.00", "10.00", venta_id=2), line(1, "2", "5.00", "90.00", venta_id=1)]
    assert silver.detalle_ventas(bronze("detalle_ventas", rows)).count() == 0


def test_newest_copy_survives(bronze, spark):
    old = bronze("clientes", [{"id": 1, "nombre": "A", "email": "a@x"}])
    new = bronze("clientes", [{"id": 1, "nombre": "Z", "email": "z@x"}])
    stamped = old.withColumn(SYNC_STAMP, F.lit(dt.datetime(2001, 1, 1))).unionByName(
        new.withColumn(SYNC_STAMP, F.lit(dt.datetime(2001, 2, 1)))
    )
    assert [row.nombre for row in silver.clientes(stamped, AS_OF).collect()] == ["Z"]


def test_clientes(bronze):
    def registered(days):
        return None if days is None else AS_OF - dt.timedelta(days=days)

    ages = [-1, 89, 90, 364, 365, None]
    rows = [
        {"id": i, "nombre": "n", "email": "e", "tipo_cliente": "VIP", "fecha_registro": registered(age)}
        for i, age in enumerate(ages)
    ]
    rows += [
        {"id": 10, "nombre": "", "email": ""},
        {"id": 11, "nombre": None, "email": "e"},
        {"id": 12, "nombre": "n", "email": None},
    ]
    kept = by_key(silver.clientes(bronze("clientes", rows), AS_OF), "cliente_id")
    assert sorted(kept) == [0, 1, 2, 3, 4, 5, 10]
    assert [kept[i].antiguedad_dias for i in range(6)] == ages
    assert [kept[i].segmento_antiguedad for i in range(6)] == [
        "Nuevo", "Nuevo", "Regular", "Regular", "Antiguo", "Antiguo",
    ]
    assert kept[0].nivel_credito_num == 3 and kept[10].nivel_credito_num == 1
    assert kept[1].fecha_registro == dt.datetime.combine(registered(89), dt.time())


def test_productos(bronze):
    def product(number, price, cost):
        return {"id": number, "nombre": "p", "precio_venta": Decimal(price), "precio_compra": Decimal(cost)}

    rows = [
        product(1, "0.00", "1.00"),
        product(2, "1.00", "0.00"),
        product(3, "2.00", "3.00"),
        product(4, "80.00", "70.00"),
        product(5, "32.00", "31.95"),
        product(6, "3.00", "2.00"),
    ]
    kept = by_key(silver.productos(bronze("productos", rows)), "producto_id")
    margins = {number: str(row.margen) for number, row in kept.items()}
    # 5: 0.15625 % rounds half up; 6: a third
    assert margins == {3: "-50.00", 4: "12.50", 5: "0.16", 6: "33.33"}
    assert {(row.categoria, row.categoria_grupo, row.proveedor_id) for row in kept.values()} == {
        ("General", "Abarrotes", 0)
    }


def test_inventario(bronze):
    def lot(number, quantity, days):
        expiry = None if days is None else AS_OF + dt.timedelta(days=days)
        stored = {"producto_id": 1, "sucursal_id": 1, "cantidad_actual": quantity, "fecha_caducidad": expiry}
        return {"id": number, **stored}

    rows = [lot(1, -1, 5), lot(2, 0, -1), lot(3, 9, 30), lot(4, 10, None), lot(5, None, 5)]
    kept = by_key(silver.inventario(bronze("inventario", rows), AS_OF), "inventario_id")
    found = {n: (r.dias_hasta_caducidad, r.estado_caducidad, r.alerta_stock) for n, r in kept.items()}
    assert found == {
        2: (-1, "Critico", "Sin Stock"),
        3: (30, "Normal", "Stock Bajo"),
        4: (999, "Optimo", "Stock OK"),
    }


def test_proveedores(bronze):
    rows = [
        {"id": 1, "nombre_empresa": "uno", "contacto_principal": "c", "telefono_principal": "t", "ciudad": "x"},
        {"id": 2, "nombre_empresa": None},
    ]
    (kept,) = silver.proveedores(bronze("proveedores", rows)).collect()
    assert (kept.proveedor_id, kept.nombre, kept.contacto, kept.telefono, kept.ciudad) == (1, "uno", "c", "t", "x")


def test_a_hot_key_and_null_keys_collapse(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    kept = by_key(one_per_key(rows.repartition(8), ["k"]), "k")
    assert len(kept) == 1002 - (1 if 7 % 3 == 1 else 0)
    assert kept[7].v == 0 and kept[None].v == 2


def test_quality_report_counts_each_rule_and_all_together(bronze):
    rows = [sale(1), sale(2, total=Decimal("0.00")), sale(3, estatus="x"), sale(4, total=None, estatus=None)]
    rows += [sale(1, cliente_id=2), sale(None), sale(None, cliente_id=2)]
    counts = quality.StepCounts()
    silver.ventas(bronze("ventas", rows), counts).write.format("noop").mode("overwrite").save()
    assert {rule: (reaching, passing) for _, _, rule, reaching, passing in counts.rows()} == {
        "total_positivo": (7, 5),
        "completada": (7, 5),
        "con_fecha": (7, 7),
        "todas": (7, 4),
        "unicas": (2, 2),
    }
