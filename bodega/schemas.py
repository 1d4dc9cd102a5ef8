"""The declared tables: columns, types and partition columns.

Two rules widen the source types, because the declared ones overflow on large tables: every
identifier is BIGINT from bronze on, and gold sums are DECIMAL(28,2).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

SYNC_STAMP = "_sync_timestamp"
TRANSFORM_STAMP = "_transform_timestamp"

# The source contract, one line of column declarations per bronze table.
BRONZE = {
    "ventas": """id INT, folio STRING, fecha_hora TIMESTAMP, cliente_id INT, empleado_id INT, sucursal_id INT,
        subtotal DECIMAL(12,2), impuestos DECIMAL(12,2), descuento DECIMAL(12,2), total DECIMAL(12,2),
        metodo_pago STRING, estatus STRING, num_productos INT""",
    "detalle_ventas": """id INT, venta_id INT, producto_id INT, cantidad DECIMAL(10,3), precio_unitario DECIMAL(10,2),
        subtotal DECIMAL(12,2), costo_unitario DECIMAL(10,2), margen_item DECIMAL(12,2)""",
    "clientes": """id INT, codigo_cliente STRING, nombre STRING, apellidos STRING, telefono STRING, email STRING,
        direccion STRING, ciudad STRING, fecha_registro DATE, tipo_cliente STRING, credito_limite DECIMAL(12,2),
        puntos_acumulados INT, activo BOOLEAN""",
    "productos": """id INT, codigo_producto STRING, nombre STRING, categoria_id INT, precio_compra DECIMAL(10,2),
        precio_venta DECIMAL(10,2), unidad_medida_id INT, stock_minimo INT, perecedero BOOLEAN, activo BOOLEAN,
        fecha_creacion DATE""",
    "sucursales": """id INT, nombre STRING, direccion STRING, telefono STRING, ciudad STRING, region STRING,
        gerente STRING, fecha_apertura DATE, area_metros DECIMAL(10,2), activa BOOLEAN, tipo_zona STRING,
        nivel_poblacion STRING, tipo_ciudad STRING""",
    "inventario": """id INT, producto_id INT, sucursal_id INT, cantidad_actual INT, fecha_ultimo_conteo DATE,
        ubicacion STRING, lote STRING, fecha_caducidad DATE, costo_promedio DECIMAL(10,2), activo BOOLEAN""",
    "empleados": """id INT, codigo_empleado STRING, nombre STRING, apellidos STRING, cargo_id INT,
        departamento_id INT, puede_vender BOOLEAN, salario DECIMAL(10,2), fecha_ingreso DATE, sucursal_id INT,
        activo BOOLEAN""",
    "proveedores": """id INT, codigo_proveedor STRING, nombre_empresa STRING, nit STRING, contacto_principal STRING,
        cargo_contacto STRING, telefono_principal STRING, telefono_secundario STRING, email_principal STRING,
        email_secundario STRING, direccion STRING, ciudad STRING, pais STRING, pagina_web STRING,
        tipo_productos STRING, categoria_especialidad STRING, calificacion DECIMAL(3,2), estado STRING,
        fecha_registro DATE, fecha_ultima_evaluacion DATE, plazo_pago_dias INT, descuento_volumen DECIMAL(5,4),
        limite_credito DECIMAL(15,2), moneda STRING, observaciones STRING, activo BOOLEAN""",
    "ordenes_compra": """id INT, numero_orden STRING, fecha_orden DATE, proveedor_id INT, estado STRING,
        subtotal DECIMAL(15,2), descuento DECIMAL(15,2), impuestos DECIMAL(15,2), total DECIMAL(15,2),
        moneda STRING, fecha_entrega_esperada DATE, fecha_entrega_real DATE, direccion_entrega STRING,
        sucursal_destino_id INT, terminos_pago STRING, observaciones STRING, usuario_creacion STRING,
        fecha_creacion DATE, usuario_aprobacion STRING, fecha_aprobacion DATE""",
    "movimientos_inventario": """id INT, numero_movimiento STRING, fecha_movimiento TIMESTAMP,
        tipo_movimiento STRING, producto_id INT, sucursal_id INT, cantidad INT, costo_unitario DECIMAL(10,2),
        costo_total DECIMAL(12,2), lote STRING, fecha_vencimiento DATE, documento_referencia STRING,
        observaciones STRING, usuario STRING, fecha_registro TIMESTAMP""",
    "recepciones": """id INT, numero_recepcion STRING, fecha_recepcion DATE, orden_compra_id INT,
        numero_orden_referencia STRING, proveedor_id INT, sucursal_id INT, estado STRING,
        porcentaje_recibido DECIMAL(5,2), valor_esperado DECIMAL(15,2), valor_recibido DECIMAL(15,2),
        numero_guia_transportadora STRING, transportadora STRING, responsable_recepcion STRING,
        observaciones STRING, danos_reportados STRING, motivo_rechazo STRING, requiere_seguimiento BOOLEAN,
        fecha_registro DATE, usuario_registro STRING""",
    "productos_erp": """id INT, codigo_producto STRING, codigo_barras STRING, nombre STRING, descripcion STRING,
        categoria_id INT, subcategoria STRING, marca STRING, modelo STRING, proveedor_id INT,
        precio_compra DECIMAL(10,2), precio_venta DECIMAL(10,2), precio_mayorista DECIMAL(10,2),
        unidad_medida_id INT, peso_gramos INT, dimensiones STRING, stock_minimo INT, stock_maximo INT,
        punto_reorden INT, perecedero BOOLEAN, dias_caducidad INT, requiere_refrigeracion BOOLEAN,
        temperatura_almacenamiento STRING, estado STRING, activo BOOLEAN, fecha_creacion DATE,
        fecha_ultima_actualizacion DATE, impuesto_iva DECIMAL(4,2), observaciones STRING""",
}

# The cleaned tables. Quantities keep the source's three decimals.
SILVER = {
    "clientes_clean": """cliente_id BIGINT, nombre STRING, email STRING, telefono STRING, ciudad STRING,
        fecha_registro TIMESTAMP, nivel_credito STRING, antiguedad_dias INT, segmento_antiguedad STRING,
        nivel_credito_num INT""",
    "productos_clean": """producto_id BIGINT, nombre STRING, categoria STRING, precio DECIMAL(10,2),
        costo DECIMAL(10,2), proveedor_id BIGINT, margen DECIMAL(10,2), categoria_grupo STRING""",
    "proveedores_clean": """proveedor_id BIGINT, nombre STRING, contacto STRING, telefono STRING, email STRING,
        ciudad STRING""",
    "inventario_clean": """inventario_id BIGINT, producto_id BIGINT, sucursal_id BIGINT, cantidad INT,
        fecha_actualizacion TIMESTAMP, fecha_caducidad DATE, dias_hasta_caducidad INT, estado_caducidad STRING,
        alerta_stock STRING""",
    "ventas_clean": """venta_id BIGINT, fecha TIMESTAMP, cliente_id BIGINT, sucursal_id BIGINT, total DECIMAL(12,2),
        estado STRING, metodo_pago STRING, fecha_date DATE, hora INT, dia_semana INT, es_fin_semana BOOLEAN,
        periodo_dia STRING""",
    "detalle_ventas_clean": """detalle_id BIGINT, venta_id BIGINT, producto_id BIGINT, cantidad DECIMAL(10,3),
        precio_unitario DECIMAL(10,2), subtotal DECIMAL(12,2)""",
}

# The star schema and the marts. Stored sums are wide enough for the largest group.
GOLD = {
    "dim_tiempo": """fecha_key DATE, anio INT, mes INT, dia INT, dia_semana INT, semana_anio INT, trimestre INT,
        mes_nombre STRING, dia_semana_nombre STRING, tipo_dia STRING, temporada STRING""",
    "dim_clientes": """cliente_key BIGINT, nombre STRING, email STRING, telefono STRING, ciudad STRING,
        fecha_registro TIMESTAMP, nivel_credito STRING, antiguedad_dias INT, segmento_antiguedad STRING,
        nivel_credito_num INT, fecha_actualizacion TIMESTAMP""",
    "dim_productos": """producto_key BIGINT, producto_nombre STRING, categoria STRING, precio DECIMAL(10,2),
        costo DECIMAL(10,2), proveedor_id BIGINT, margen DECIMAL(10,2), categoria_grupo STRING,
        fecha_actualizacion TIMESTAMP""",
    "dim_sucursales": """sucursal_key BIGINT, sucursal_nombre STRING, ciudad STRING, region STRING, gerente STRING,
        fecha_actualizacion TIMESTAMP""",
    "fact_ventas": """venta_id BIGINT, fecha_key DATE, cliente_key BIGINT, sucursal_key BIGINT, total DECIMAL(12,2),
        metodo_pago STRING, hora INT, dia_semana INT, es_fin_semana BOOLEAN, periodo_dia STRING,
        cantidad_total_items DECIMAL(20,3), num_items_distintos BIGINT, margen_total DECIMAL(28,2),
        ticket_promedio_item DECIMAL(18,2), fecha_carga TIMESTAMP""",
    "fact_kpis_diarios": """fecha_key DATE, sucursal_key BIGINT, ventas_totales DECIMAL(28,2),
        numero_transacciones BIGINT, ticket_promedio DECIMAL(18,2), margen_bruto_total DECIMAL(28,2),
        clientes_unicos BIGINT, items_vendidos DECIMAL(20,3), ventas_fin_semana BIGINT,
        ventas_manana DECIMAL(28,2), ventas_tarde DECIMAL(28,2), ventas_noche DECIMAL(28,2)""",
    "fact_analisis_clientes": """cliente_key BIGINT, ultima_compra DATE, frecuencia_compras BIGINT,
        valor_total_compras DECIMAL(28,2), ticket_promedio_cliente DECIMAL(18,2), items_totales DECIMAL(20,3),
        sucursales_visitadas BIGINT, recency_dias INT, segmento_rfm STRING""",
    "fact_rendimiento_productos": """producto_id BIGINT, unidades_vendidas DECIMAL(20,3),
        ingresos_totales DECIMAL(28,2), margen_total DECIMAL(28,2), numero_ventas BIGINT,
        transacciones_unicas BIGINT""",
    "fact_inventario": """inventario_id BIGINT, producto_key BIGINT, sucursal_key BIGINT, fecha_key DATE, cantidad INT,
        valor_inventario DECIMAL(28,2), valor_venta_potencial DECIMAL(28,2), fecha_actualizacion TIMESTAMP,
        fecha_caducidad DATE, dias_hasta_caducidad INT, estado_caducidad STRING, alerta_stock STRING,
        requiere_accion BOOLEAN, fecha_carga TIMESTAMP""",
    "fact_kpis_inventario": """sucursal_key BIGINT, stock_total BIGINT, valor_total_inventario DECIMAL(28,2),
        valor_venta_potencial_total DECIMAL(28,2), items_unicos BIGINT, items_criticos BIGINT, items_alerta BIGINT,
        items_sin_stock BIGINT, items_stock_bajo BIGINT, dias_promedio_caducidad DOUBLE""",
    "fact_alertas_inventario": """inventario_id BIGINT, producto_key BIGINT, sucursal_key BIGINT, cantidad INT,
        estado_caducidad STRING, dias_hasta_caducidad INT, alerta_stock STRING, valor_inventario DECIMAL(28,2),
        prioridad STRING, accion_recomendada STRING, fecha_alerta TIMESTAMP""",
}

# Partition columns, and the columns each table is clustered by.
PARTITIONS = {
    "inventario_clean": ("sucursal_id",),
    "ventas_clean": ("fecha_date",),
    "fact_ventas": ("fecha_key",),
    "fact_kpis_diarios": ("fecha_key",),
    "fact_inventario": ("sucursal_key",),
}


@dataclass(frozen=True)
class TableSpec:
    layer: str
    name: str
    columns: tuple[tuple[str, str], ...]
    partition: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.layer}.{self.name}"

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in self.columns)


def _declared(ddl: str) -> list[tuple[str, str]]:
    parts = re.split(r",\s*(?![^(]*\))", ddl)
    return [tuple(part.split(None, 1)) for part in map(str.strip, parts)]


def _widened(name: str, kind: str) -> tuple[str, str]:
    is_identifier = name == "id" or name.endswith("_id")
    return name, "BIGINT" if is_identifier and kind == "INT" else kind


def _specs():
    stamps = {"bronze": [(SYNC_STAMP, "TIMESTAMP")], "silver": [(TRANSFORM_STAMP, "TIMESTAMP")], "gold": []}
    for layer, tables in (("bronze", BRONZE), ("silver", SILVER), ("gold", GOLD)):
        for name, ddl in tables.items():
            columns = [_widened(*column) for column in _declared(ddl)] + stamps[layer]
            yield TableSpec(layer, name, tuple(columns), PARTITIONS.get(name, ()))


TABLES: dict[str, TableSpec] = {spec.key: spec for spec in _specs()}


def spec_of(table: str) -> TableSpec:
    if table not in TABLES:
        raise KeyError(f"unknown table {table!r}; declared: {', '.join(sorted(TABLES))}")
    return TABLES[table]


def declared(df: DataFrame, table: str) -> DataFrame:
    """The declared columns of ``table`` out of ``df``, types and all other columns left aside.

    Datasets say only what they rename and compute; which columns make up the result is said here, once.
    """
    return df.select(*spec_of(table).names)


def conform(df: DataFrame, table: str, without: tuple[str, ...] = ()) -> DataFrame:
    """Columns of ``df`` by name, cast to the declared types and in the declared order.

    A value that does not fit its type fails the query, whether or not the session checks casts itself.
    """
    wanted = [(name, kind) for name, kind in spec_of(table).columns if name not in without]
    names = {name for name, _ in wanted}
    missing, unknown = names - set(df.columns), set(df.columns) - names
    if missing or unknown:
        raise ValueError(f"{table}: missing columns {sorted(missing)}, undeclared columns {sorted(unknown)}")
    checked_by_spark = df.sparkSession.conf.get("spark.sql.ansi.enabled").lower() == "true"

    def column(name: str, kind: str) -> str:
        if checked_by_spark:
            return f"CAST({name} AS {kind}) AS {name}"
        fitted, problem = f"TRY_CAST({name} AS {kind})", f"{table}.{name}: value does not fit {kind}"
        lost = f"{name} IS NOT NULL AND {fitted} IS NULL"
        return f"CASE WHEN {lost} THEN RAISE_ERROR('{problem}') ELSE {fitted} END AS {name}"

    return df.selectExpr(*[column(name, kind) for name, kind in wanted])


def schema_rows() -> list[tuple[str, str, int, str, str, bool]]:
    """(layer, table, position, column, type, is partition column) for every declared column."""
    return [
        (spec.layer, spec.name, position, name, kind, name in spec.partition)
        for spec in TABLES.values()
        for position, (name, kind) in enumerate(spec.columns)
    ]
