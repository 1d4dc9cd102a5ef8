"""TPC-H-shaped parquet tables, read as they are and mapped onto the bronze tables.

The mapping gives the retail pipeline real inputs of any size. Every column is an SQL expression that Spark
and DuckDB both accept, so the comparison SQL in ``bodega.contract`` starts from the same rows.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bodega.functions.rules import instant
from bodega.schemas import SYNC_STAMP, spec_of
from bodega.session import materialise

# The "today" and the load time that go with this data.
AS_OF = dt.date(2001, 8, 2)
RUN_TS = dt.datetime(2001, 8, 2, 13, 0, 0)

BRANCHES = 25

_TODAY = f"DATE '{AS_OF}'"
# Prices are positive with two decimals, so adding a half and flooring rounds them; round() is far slower.
_LINE_CENTS = "cast(floor(l_extendedprice * 100 + 0.5) as bigint)"
_PART_CENTS = "cast(floor(p_retailprice * 100 + 0.5) as bigint)"
_QUANTITY = "cast(l_quantity as bigint)"
_COST_CENTS = f"{_PART_CENTS} * (55 + p_size)"

_PRODUCT = {
    "id": "p_partkey",
    "nombre": "p_name",
    "precio_venta": f"cast((case when p_partkey % 41 = 0 then 0 else {_PART_CENTS} end) * 0.01 as decimal(10,2))",
    "precio_compra": f"cast(cast(({_COST_CENTS} - {_COST_CENTS} % 100) / 100 as bigint) * 0.01 as decimal(10,2))",
}

# Bronze column -> expression over the source rows of that table; columns not listed are NULL.
COLUMNS: dict[str, dict[str, str]] = {
    "ventas": {
        "id": "o_orderkey",
        "fecha_hora": "cast(o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR as timestamp)",
        "cliente_id": "case when o_custkey % 97 = 0 then null when o_custkey % 3 = 0 then o_custkey % 60"
        " else o_custkey end",
        "sucursal_id": f"o_orderkey % {BRANCHES}",
        "total": "cast(o_totalprice as decimal(12,2))",
        "metodo_pago": "o_orderpriority",
        "estatus": "case o_orderstatus when 'F' then 'completada' when 'O' then 'pendiente' else 'cancelada' end",
    },
    "detalle_ventas": {
        "id": "l_orderkey * 10 + l_linenumber",
        "venta_id": "l_orderkey",
        "producto_id": "l_partkey",
        "cantidad": "cast(l_quantity as decimal(10,3))",
        "precio_unitario": f"cast(cast(({_LINE_CENTS} - {_LINE_CENTS} % {_QUANTITY}) / {_QUANTITY} as bigint)"
        " * 0.01 as decimal(10,2))",
        "subtotal": f"cast({_LINE_CENTS} * 0.01 + (case when l_linenumber = 7 then 5.00 else 0.00 end)"
        " as decimal(12,2))",
    },
    "clientes": {
        "id": "c_custkey",
        "nombre": "c_name",
        "email": "case when c_custkey % 17 = 0 then null else concat(lower(c_name), '@example.com') end",
        "telefono": "concat('T', cast(c_custkey as varchar(20)))",
        "ciudad": "n_name",
        "fecha_registro": "case when c_custkey % 23 = 0 then null else"
        f" cast({_TODAY} - cast(c_custkey * 7 % 900 as int) * INTERVAL '1' DAY as date) end",
        "tipo_cliente": "case c_mktsegment when 'BUILDING' then 'VIP' when 'MACHINERY' then 'Regular'"
        " when 'HOUSEHOLD' then 'Regular' else 'Ocasional' end",
    },
    "productos": _PRODUCT,
    "productos_erp": _PRODUCT,
    "proveedores": {
        "id": "s_suppkey",
        "nombre_empresa": "case when s_suppkey % 19 = 0 then null else s_name end",
        "contacto_principal": "s_name",
        "telefono_principal": "concat('T', cast(s_suppkey as varchar(20)))",
        "email_principal": "concat(lower(s_name), '@example.com')",
        "ciudad": "n_name",
        "activo": "s_acctbal > 0",
    },
    "sucursales": {
        "id": "n_nationkey",
        "nombre": "concat('Sucursal ', n_name)",
        "ciudad": "n_name",
        "region": "r_name",
        "gerente": "concat('Gerente ', n_name)",
        "activa": "n_nationkey % 7 <> 0",
    },
    "inventario": {
        "id": f"p_partkey * {BRANCHES} + n_nationkey",
        "producto_id": "p_partkey",
        "sucursal_id": "n_nationkey",
        "cantidad_actual": "cast((p_partkey * 13 + n_nationkey * 8) % 40 - 1 as int)",
        "fecha_ultimo_conteo": "DATE '2001-07-01'",
        "fecha_caducidad": "case when (p_partkey + n_nationkey) % 11 = 0 then null else"
        f" cast({_TODAY} + cast((p_partkey * 7 + n_nationkey * 3) % 150 - 5 as int) * INTERVAL '1' DAY as date) end",
    },
    "empleados": {
        "id": "s_suppkey",
        "codigo_empleado": "concat('E', cast(s_suppkey as varchar(20)))",
        "nombre": "s_name",
        "puede_vender": "s_suppkey % 3 <> 0",
        "salario": "cast(abs(s_acctbal) as decimal(10,2))",
        "sucursal_id": f"s_suppkey % {BRANCHES}",
        "activo": "s_acctbal > 0",
    },
    "movimientos_inventario": {
        "id": "l_orderkey * 10 + l_linenumber",
        "numero_movimiento": "concat('M', cast(l_orderkey as varchar(20)))",
        "fecha_movimiento": "cast(l_shipdate as timestamp)",
        "tipo_movimiento": "case l_returnflag when 'R' then 'devolucion' else 'salida' end",
        "producto_id": "l_partkey",
        "sucursal_id": f"l_orderkey % {BRANCHES}",
        "cantidad": "cast(l_quantity as int)",
    },
    "recepciones": {
        "id": "l_orderkey * 1000 + l_suppkey % 1000",
        "fecha_recepcion": "cast(first_ship as date)",
        "orden_compra_id": "l_orderkey * 1000 + l_suppkey % 1000",
        "proveedor_id": "l_suppkey",
        "sucursal_id": f"l_orderkey % {BRANCHES}",
        "estado": "last_status",
        "valor_recibido": "cast(cents * 0.01 as decimal(15,2))",
    },
    "ordenes_compra": {
        "id": "l_orderkey * 1000 + l_suppkey % 1000",
        "fecha_orden": "cast(first_ship as date)",
        "proveedor_id": "l_suppkey",
        "estado": "last_status",
        "total": "cast(cents * 0.01 as decimal(15,2))",
    },
}


# Source tables made of the lines added up per order and supplier.
PURCHASES = ("ordenes_compra", "recepciones")

_known_schemas: dict[tuple[str, str], StructType] = {}


class TpchTables:
    """The parquet tables of one folder. Their files are read-only, so each schema is looked up once per session."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._stored_purchases: DataFrame | None = None
        self._storing = threading.Lock()

    def raw(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        key = (self.spark.sparkContext.applicationId, path)
        if key not in _known_schemas:
            _known_schemas[key] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_known_schemas[key]).parquet(path)

    def money(self, name: str, **decimals: str) -> DataFrame:
        """A raw table with some columns as exact decimals, so that sums do not depend on row order."""
        return self.raw(name).withColumns({column: F.col(column).cast(kind) for column, kind in decimals.items()})

    def purchases(self) -> DataFrame:
        """The lines added up per order and supplier."""
        sums = {"first_ship": F.min("l_shipdate"), "last_status": F.max("l_linestatus"), "cents": F.sum(F.expr(_LINE_CENTS))}
        per_order = self.raw("lineitem").groupBy("l_orderkey", "l_suppkey")
        return per_order.agg(*[total.alias(name) for name, total in sums.items()])

    def _source_rows(self, table: str) -> DataFrame:
        if table == "ventas":
            return self.raw("orders")
        if table == "detalle_ventas":
            return self.raw("lineitem")
        if table == "clientes":
            customer, nation = self.raw("customer"), self.raw("nation")
            return customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        if table in ("productos", "productos_erp"):
            return self.raw("part")
        if table == "empleados":
            return self.raw("supplier")
        if table == "movimientos_inventario":
            return self.raw("lineitem")
        if table == "proveedores":
            supplier, nation = self.raw("supplier"), self.raw("nation")
            return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        if table == "sucursales":
            nation, region = self.raw("nation"), self.raw("region")
            return nation.join(region, nation.n_regionkey == region.r_regionkey)
        if table == "inventario":
            # Each product is stocked in every fifth branch: five lots per product, no join needed.
            branch = F.explode(F.expr(f"sequence(p_partkey % 5, {BRANCHES - 1}, 5)"))
            return self.raw("part").withColumn("n_nationkey", branch)
        if table in PURCHASES:
            return self.purchases()
        raise KeyError(table)

    def source(self, table: str) -> DataFrame:
        """A source table as an operational database would give it: no audit column."""
        return self._mapped(table, self._source_rows(table))

    def source_of_all(self, table: str) -> DataFrame:
        """``source`` for a reader of all tables: the purchases, which two of them need, are added up and written once."""
        if table not in PURCHASES:
            return self.source(table)
        with self._storing:
            if self._stored_purchases is None:
                self._stored_purchases = materialise(self.purchases(), "purchases", "zstd")
        return self._mapped(table, self._stored_purchases)

    def _mapped(self, table: str, rows: DataFrame) -> DataFrame:
        given = COLUMNS[table]
        columns = [
            f"cast({given.get(name, 'null')} as {kind}) as {name}"
            for name, kind in spec_of(f"bronze.{table}").columns
            if name != SYNC_STAMP
        ]
        return rows.selectExpr(*columns)

    def bronze(self, table: str) -> DataFrame:
        """The bronze table the ingest would store."""
        return self.source(table).withColumn(SYNC_STAMP, instant(RUN_TS))
