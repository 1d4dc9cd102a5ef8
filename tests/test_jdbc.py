"""The options a database read asks for. No database is started: the reader is a recorder."""

from __future__ import annotations

import sqlite3

import pytest

from bodega.schemas import BRONZE
from bodega.sources.jdbc import MYSQL_TABLES, POSTGRES_TABLES, JdbcSource, slices_between


class Recorder:
    """Stands in for ``spark.read``; statements are answered by a table in memory."""

    def __init__(self, ids):
        self.ids, self.loads = ids, []
        self.database = sqlite3.connect(":memory:")
        for name in set(POSTGRES_TABLES.values()):
            self.database.execute(f"CREATE TABLE {name} (id INTEGER)")
            self.database.executemany(f"INSERT INTO {name} VALUES (?)", [(i,) for i in ids])

    @property
    def read(self):
        return Reader(self, {})


class Reader:
    def __init__(self, recorder, options):
        self.recorder, self.given = recorder, options

    def format(self, name):
        return Reader(self.recorder, {**self.given, "format": name})

    def option(self, key, value):
        return self.options(**{key: value})

    def options(self, **options):
        return Reader(self.recorder, {**self.given, **options})

    def load(self):
        self.recorder.loads.append(self.given)
        return self

    def jdbc(self, url, table, predicates, properties):
        self.recorder.loads.append({"url": url, "dbtable": table, "predicates": predicates, **properties})
        return self

    def collect(self):
        return self.recorder.database.execute(self.given["query"]).fetchall()

    def first(self):
        return self.collect()[0]


def source(**changes):
    return JdbcSource("jdbc:postgresql://db/shop", "reader", "secret", POSTGRES_TABLES, **changes)


def rows_by_slice(spark, conditions, table="ventas_recientes"):
    return [spark.database.execute(f"SELECT COUNT(*) FROM {table} WHERE {c}").fetchone()[0] for c in conditions]


@pytest.mark.parametrize(
    "ids",
    [
        list(range(1, 1001)),
        [*range(900), *(10**12 + 7 * i for i in range(100))],
        [2**i for i in range(60)] * 16 + list(range(40)),
        [*range(700), *[None] * 300],
    ],
    ids=["even", "far apart", "doubling, repeated", "nulls"],
)
def test_slices_have_about_equally_many_rows_and_lose_none(ids):
    spark = Recorder(ids)
    source(slice_rows=100).read(spark, "ventas")
    counted, asked, scan = spark.loads
    assert counted["query"] == "SELECT COUNT(*) AS row_count FROM ventas_recientes"
    assert "NTILE(10) OVER (ORDER BY id)" in asked["query"]
    assert scan["dbtable"] == "ventas_recientes" and scan["driver"] == "org.postgresql.Driver"
    assert scan["fetchsize"] == "10000"
    counts = rows_by_slice(spark, scan["predicates"])
    assert sum(counts) == len(ids)
    nulls = ids.count(None)
    assert counts[0] <= 100 + nulls and max(counts[1:]) <= 116


def test_number_of_slices_follows_from_the_rows():
    for rows, number in ((0, 1), (1, 1), (100, 1), (101, 2), (100_000, 1000)):
        spark = Recorder(range(rows))
        source(slice_rows=100).read(spark, "clientes")
        assert len(spark.loads[-1]["predicates"]) == number


def test_text_bounds_are_quoted():
    assert slices_between("code", ["b", "o'a", "b"]) == [
        "code < 'b' OR code IS NULL",
        "code >= 'b' AND code < 'o''a'",
        "code >= 'o''a'",
    ]


def test_statement_runs_in_the_database():
    spark = Recorder([])
    JdbcSource("jdbc:mysql://db/erp", "u", "p", MYSQL_TABLES).query(spark, "SELECT COUNT(*) FROM proveedores_completo")
    (load,) = spark.loads
    assert load["query"].startswith("SELECT COUNT(*)") and "dbtable" not in load
    assert load["driver"] == "com.mysql.cj.jdbc.Driver"


def test_every_bronze_table_has_one_source():
    assert set(POSTGRES_TABLES) | set(MYSQL_TABLES) == set(BRONZE)
    assert not set(POSTGRES_TABLES) & set(MYSQL_TABLES)


def test_password_is_not_shown():
    assert "secret" not in repr(source())
