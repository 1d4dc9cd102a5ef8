"""Cleaned datasets. Each takes a bronze frame and gives the declared silver columns, without audit stamp.

Only the columns a dataset keeps take part in choosing between duplicates, so the scan reads nothing else.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.functions import rules
from bodega.operators import quality
from bodega.operators.dedup import one_per_key
from bodega.schemas import SYNC_STAMP, TRANSFORM_STAMP, conform, spec_of

COMPLETED = "completada"

# What a bronze row must satisfy to be kept, by table and by name. A NULL outcome rejects the row.
CHECKS: dict[str, dict[str, str]] = {
    "ventas": {
        "total_positivo": "total > 0",
        "completada": f"estatus = '{COMPLETED}'",
        "con_fecha": "fecha_hora IS NOT NULL",
    },
    "detalle_ventas": {
        "cantidad_positiva": "cantidad > 0",
        "precio_positivo": "precio_unitario > 0",
        "subtotal_positivo": "subtotal > 0",
    },
    "clientes": {"con_nombre": "nombre IS NOT NULL", "con_email": "email IS NOT NULL"},
    "productos": {"precio_venta_positivo": "precio_venta > 0", "precio_compra_positivo": "precio_compra > 0"},
    "proveedores": {"con_empresa": "nombre_empresa IS NOT NULL"},
    "inventario": {"cantidad_no_negativa": "cantidad_actual >= 0"},
}

# Products carry no category or supplier of their own yet.
UNCLASSIFIED = {"categoria": "General", "categoria_grupo": "Abarrotes", "proveedor_id": 0}

# A sale line whose subtotal is off by this much or more is rejected.
RECONCILIATION_LIMIT = 1


def all_checks(table: str) -> Column:
    return F.expr(" AND ".join(f"({check})" for check in CHECKS[table].values()))


def accepted(
    bronze: DataFrame, table: str, columns: Sequence[str], counts: quality.StepCounts | None = None
) -> DataFrame:
    """Rows passing the checks of ``table``, one per id, reduced to ``columns``.

    ``counts`` gets the rows of every check, of all together, and those left after the dedup.
    """
    newest_by = SYNC_STAMP if SYNC_STAMP in bronze.columns else None
    rows = bronze.select(*columns, newest_by) if newest_by else bronze.select(*columns)
    valid = all_checks(table)
    if counts:
        rows = counts.through(rows, "silver", table, {**CHECKS[table], quality.ALL_CHECKS: valid})
    unique = one_per_key(rows.filter(valid), ["id"], newest_by).select(*columns)
    return counts.through(unique, "silver", table, {quality.UNIQUE: F.lit(True)}) if counts else unique


def _finish(df: DataFrame, table: str) -> DataFrame:
    """The declared columns in their declared types; the writer adds the stamp."""
    kept = [name for name in spec_of(f"silver.{table}").names if name != TRANSFORM_STAMP]
    return conform(df.select(*kept), f"silver.{table}", without=(TRANSFORM_STAMP,))


def ventas(bronze: DataFrame, counts: quality.StepCounts | None = None) -> DataFrame:
    columns = ["id", "fecha_hora", "cliente_id", "sucursal_id", "total", "estatus", "metodo_pago"]
    renames = {"id": "venta_id", "fecha_hora": "fecha", "estatus": "estado"}
    moment = F.col("fecha")
    parts = {
        "fecha_date": F.to_date(moment),
        "hora": F.hour(moment),
        "dia_semana": F.dayofweek(moment),
        "es_fin_semana": rules.is_weekend(moment),
        "periodo_dia": rules.day_part(moment),
    }
    sales = accepted(bronze, "ventas", columns, counts).withColumnsRenamed(renames)
    return _finish(sales.withColumns(parts), "ventas_clean")


def reconciles() -> Column:
    return F.abs(F.col("subtotal") - F.col("cantidad") * F.col("precio_unitario")) < RECONCILIATION_LIMIT


def reconciled(lines: DataFrame) -> DataFrame:
    """Lines whose subtotal agrees with quantity times price. Applied after dedup: the order decides
    which copy of a line is judged."""
    return lines.filter(reconciles())


def detalle_ventas(bronze: DataFrame, counts: quality.StepCounts | None = None) -> DataFrame:
    columns = ["id", "venta_id", "producto_id", "cantidad", "precio_unitario", "subtotal"]
    lines = accepted(bronze, "detalle_ventas", columns, counts)
    if counts:
        lines = counts.through(lines, "silver", "detalle_ventas", {quality.RECONCILED: reconciles()})
    lines = reconciled(lines)
    return _finish(lines.withColumnRenamed("id", "detalle_id"), "detalle_ventas_clean")


def clientes(
    bronze: DataFrame, as_of: dt.date, counts: quality.StepCounts | None = None
) -> DataFrame:
    columns = ["id", "nombre", "email", "telefono", "ciudad", "fecha_registro", "tipo_cliente"]
    rows = accepted(bronze, "clientes", columns, counts)
    aged = rows.withColumn("antiguedad_dias", rules.days_since(F.col("fecha_registro"), as_of))
    labelled = aged.withColumns(
        {
            "segmento_antiguedad": rules.tenure_segment(F.col("antiguedad_dias")),
            "nivel_credito_num": rules.credit_rank(F.col("tipo_cliente")),
        }
    )
    return _finish(
        labelled.withColumnsRenamed({"id": "cliente_id", "tipo_cliente": "nivel_credito"}), "clientes_clean"
    )


def productos(bronze: DataFrame, counts: quality.StepCounts | None = None) -> DataFrame:
    """The stored margin is rounded to two places; everything in gold starts from that rounded value."""
    renames = {"id": "producto_id", "precio_venta": "precio", "precio_compra": "costo"}
    rows = accepted(bronze, "productos", ["nombre", *renames], counts).withColumnsRenamed(renames)
    margin = rules.margin_percent(F.col("precio"), F.col("costo"))
    constants = {name: F.lit(value) for name, value in UNCLASSIFIED.items()}
    return _finish(rows.withColumns({"margen": margin, **constants}), "productos_clean")


def proveedores(bronze: DataFrame, counts: quality.StepCounts | None = None) -> DataFrame:
    renames = {
        "id": "proveedor_id",
        "nombre_empresa": "nombre",
        "contacto_principal": "contacto",
        "telefono_principal": "telefono",
        "email_principal": "email",
    }
    rows = accepted(bronze, "proveedores", [*renames, "ciudad"], counts)
    return _finish(rows.withColumnsRenamed(renames), "proveedores_clean")


def inventario(
    bronze: DataFrame, as_of: dt.date, counts: quality.StepCounts | None = None
) -> DataFrame:
    columns = ["id", "producto_id", "sucursal_id", "cantidad_actual", "fecha_ultimo_conteo", "fecha_caducidad"]
    rows = accepted(bronze, "inventario", columns, counts)
    dated = rows.withColumn("dias_hasta_caducidad", rules.days_to_expiry(F.col("fecha_caducidad"), as_of))
    labelled = dated.withColumns(
        {
            "estado_caducidad": rules.expiry_state(F.col("dias_hasta_caducidad")),
            "alerta_stock": rules.stock_alert(F.col("cantidad_actual")),
        }
    )
    renames = {"id": "inventario_id", "cantidad_actual": "cantidad", "fecha_ultimo_conteo": "fecha_actualizacion"}
    return _finish(labelled.withColumnsRenamed(renames), "inventario_clean")
