from __future__ import annotations

import datetime as dt
import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bodega.schemas import SYNC_STAMP, spec_of  # noqa: E402
from bodega.session import build_session  # noqa: E402
from bodega.sinks.warehouse import Warehouse  # noqa: E402

AS_OF = dt.date(2001, 8, 2)
RUN_TS = dt.datetime(2001, 8, 2, 13)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("spark-warehouse")),
    }
    session = build_session("bodega-tests", "local[4]", settings)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def new_warehouse(spark, tmp_path):
    def make(**options) -> Warehouse:
        return Warehouse(spark, str(tmp_path / "lake"), prefix=f"t_{uuid.uuid4().hex}_", **options)

    return make


@pytest.fixture
def bronze(spark):
    """Bronze rows from dicts; columns left out are NULL."""

    def make(table: str, rows: list[dict]):
        columns = [(name, kind) for name, kind in spec_of(f"bronze.{table}").columns if name != SYNC_STAMP]
        ddl = ", ".join(f"{name} {kind}" for name, kind in columns)
        unknown = {name for row in rows for name in row} - {name for name, _ in columns}
        assert not unknown, unknown
        return spark.createDataFrame([tuple(row.get(name) for name, _ in columns) for row in rows], ddl)

    return make


def by_key(df, key: str) -> dict:
    return {row[key]: row for row in df.collect()}
