"""Reading operational databases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession

# Bronze table -> table or view in the source system.
POSTGRES_TABLES = {
    "sucursales": "sucursales",
    "clientes": "clientes",
    "productos": "productos_activos",
    "empleados": "empleados",
    "inventario": "inventario_actual",
    "ventas": "ventas_recientes",
    "detalle_ventas": "detalle_ventas_recientes",
}
MYSQL_TABLES = {
    "proveedores": "proveedores_completo",
    "ordenes_compra": "ordenes_compra",
    "movimientos_inventario": "movimientos_inventario",
    "recepciones": "recepciones_mercancia",
    "productos_erp": "productos_completo",
}
DRIVERS = {"postgresql": "org.postgresql.Driver", "mysql": "com.mysql.cj.jdbc.Driver"}


def _literal(value: object) -> str:
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"


def slices_between(column: str, bounds: Sequence[object]) -> list[str]:
    """Conditions that part a table at ``bounds``, each row in exactly one; rows without a value go to the first.

    The outer slices are open, so rows that arrive after the bounds were asked for belong somewhere.
    """
    cuts = [_literal(bound) for bound in sorted(set(bounds))]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in pairwise(cuts)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


@dataclass(frozen=True)
class JdbcSource:
    """A database and the names its tables have there. Credentials come from the caller's secret store."""

    url: str
    user: str
    password: str = field(repr=False)
    tables: Mapping[str, str]
    split_column: str = "id"
    slice_rows: int = 1_000_000
    fetch_size: int = 10_000

    @property
    def _options(self) -> dict[str, str]:
        kind = self.url.split(":")[1]
        driver = {"driver": DRIVERS[kind]} if kind in DRIVERS else {}
        return {"user": self.user, "password": self.password, "fetchsize": str(self.fetch_size), **driver}

    def query(self, spark: SparkSession, sql: str) -> DataFrame:
        """The rows of a statement that the database itself executes."""
        return spark.read.format("jdbc").options(url=self.url, **self._options).option("query", sql).load()

    def bounds(self, spark: SparkSession, table: str) -> list[object]:
        """Where slices of about ``slice_rows`` rows begin, but for the first; the database counts its own rows.

        The number of slices follows from the number of rows, and equal numbers of rows lie between the bounds however
        unevenly the values of the split column are spread.
        """
        name, column = self.tables[table], self.split_column
        rows = self.query(spark, f"SELECT COUNT(*) AS row_count FROM {name}").first()[0]
        number = -(-rows // self.slice_rows)
        if number < 2:
            return []
        tiles = f"SELECT {column}, NTILE({number}) OVER (ORDER BY {column}) AS tile FROM {name} WHERE {column} IS NOT NULL"
        begins = f"SELECT MIN({column}) AS begins FROM ({tiles}) AS tiles WHERE tile > 1 GROUP BY tile"
        return [row[0] for row in self.query(spark, begins).collect()]

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The whole source table for a bronze table, in parallel slices of about equally many rows."""
        conditions = slices_between(self.split_column, self.bounds(spark, table))
        return spark.read.jdbc(self.url, self.tables[table], predicates=conditions, properties=self._options)
