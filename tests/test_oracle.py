"""Every registered query against its SQL twin, over whole tables. ``ORACLE_SF`` picks the folders."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from bodega.contract import oracle, registry

SCALES = os.environ.get("ORACLE_SF", "0.001").split(",")


@pytest.fixture(scope="module", params=SCALES)
def data(request):
    folder = f"/root/testdata/sf{request.param}"
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return folder, connection


def test_both_sides_name_the_same_queries():
    assert set(registry.queries()) == set(oracle.statements())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(registry.queries()))
def test_same_rows(spark, data, name):
    folder, connection = data
    df = contract.queries()[name](spark, folder)
    answer = connection.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in answer.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    expected = sorted(repr([row[columns.index(c)] for c in order]) for row in answer.fetchall())
    found = sorted(repr([row[c] for c in order]) for row in df.collect())
    assert found == expected
    assert found, "an empty result would prove nothing"


def test_entry_is_the_daily_kpis(spark):
    df = contract.entry(spark)
    assert df.count() == 493 and df.columns[:2] == ["fecha_key", "sucursal_key"]
