"""Every threshold, from both sides."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from bodega.functions import rules
from bodega.functions.ladders import first_match


@pytest.fixture
def evaluate(spark):
    """Values of a rule over one or more columns of literal rows."""

    def run(rule, ddl: str, rows: list[tuple]):
        df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {ddl}")
        columns = [F.col(name) for name in df.columns[1:]]
        return [row.v for row in df.select("i", rule(*columns).alias("v")).orderBy("i").collect()]

    return run


def test_day_part_limits(evaluate):
    hours = [0, 5, 6, 11, 12, 17, 18, 23]
    moments = [(dt.datetime(2001, 8, 1, hour, 59),) for hour in hours]
    expected = ["Noche", "Noche", "Mañana", "Mañana", "Tarde", "Tarde", "Noche", "Noche"]
    assert evaluate(rules.day_part, "t timestamp", moments) == expected


def test_weekend_and_day_type(evaluate):
    days = [(dt.date(2001, 8, day),) for day in (3, 4, 5, 6)] + [(None,)]
    assert evaluate(rules.is_weekend, "d date", days) == [False, True, True, False, False]
    assert evaluate(rules.day_type, "d date", days[:2]) == ["Entre Semana", "Fin de Semana"]


def test_season(evaluate):
    months = [(dt.date(2024, month, 15),) for month in range(1, 13)]
    labels = evaluate(rules.season, "d date", months)
    assert labels == [
        "Alta", "Media", "Media", "Baja", "Baja", "Alta", "Alta", "Media", "Media", "Baja", "Baja", "Alta",
    ]


def test_tenure(evaluate):
    days = [-1, 0, 89, 90, 364, 365, None]
    expected = ["Nuevo", "Nuevo", "Nuevo", "Regular", "Regular", "Antiguo", "Antiguo"]
    assert evaluate(rules.tenure_segment, "d int", [(day,) for day in days]) == expected


def test_credit_rank_is_case_sensitive(evaluate):
    kinds = [("VIP",), ("Regular",), ("vip",), ("Ocasional",), (None,)]
    assert evaluate(rules.credit_rank, "k string", kinds) == [3, 2, 1, 1, 1]


def test_expiry(evaluate):
    distances = [-1, 6, 7, 29, 30, 89, 90]
    days = [(AS_OF + dt.timedelta(days=n),) for n in distances] + [(None,)]
    assert evaluate(lambda d: rules.days_to_expiry(d, AS_OF), "d date", days) == [*distances, 999]
    states = ["Critico", "Critico", "Alerta", "Alerta", "Normal", "Normal", "Optimo", "Optimo"]
    assert evaluate(lambda d: rules.expiry_state(rules.days_to_expiry(d, AS_OF)), "d date", days) == states


def test_stock_alert(evaluate):
    quantities = [(0,), (1,), (9,), (10,), (None,)]
    expected = ["Sin Stock", "Stock Bajo", "Stock Bajo", "Stock OK", "Stock OK"]
    assert evaluate(rules.stock_alert, "q int", quantities) == expected


def test_needs_action_ignores_low_stock(evaluate):
    rows = [
        ("Critico", "Stock OK"), ("Alerta", "Stock Bajo"), ("Normal", "Sin Stock"), ("Optimo", "Stock Bajo"),
        ("Normal", "Stock OK"), (None, None),
    ]
    assert evaluate(rules.needs_action, "s string, a string", rows) == [True, True, True, False, False, False]


def test_priority(evaluate):
    rows = [("Critico", "Stock OK"), ("Alerta", "Sin Stock"), ("Alerta", "Stock Bajo"), ("Normal", "Stock OK")]
    assert evaluate(rules.priority, "s string, a string", rows) == ["Alta", "Alta", "Media", "Baja"]


def test_expiry_comes_before_restocking(evaluate):
    rows = [
        (6, "Sin Stock"), (7, "Sin Stock"), (14, "Stock OK"), (15, "Sin Stock"), (20, "Stock Bajo"), (29, "Stock OK"),
        (999, "Sin Stock"),
    ]
    assert evaluate(rules.recommended_action, "d int, a string", rows) == [
        "Liquidar urgente", "Promocionar", "Promocionar", "Reabastecer urgente", "Reabastecer", "Monitorear",
        "Reabastecer urgente",
    ]


@pytest.mark.parametrize(
    "recency, frequency, value, segment",
    [
        (29, 11, "1000000.01", "Champions"),
        (29, 11, "1000000.00", "Leales"),
        (29, 10, "1000000.01", "Leales"),
        (30, 11, "1000000.01", "Leales"),
        (59, 6, "1.00", "Leales"),
        (59, 5, "1.00", "Potenciales"),
        (60, 6, "1.00", "Potenciales"),
        (89, 3, "1.00", "Potenciales"),
        (89, 2, "1.00", "Regulares"),
        (90, 50, "9999999.00", "Regulares"),
        (180, 1, "1.00", "Regulares"),
        (181, 50, "9999999.00", "En Riesgo"),
    ],
)
def test_rfm(evaluate, recency, frequency, value, segment):
    row = [(recency, frequency, Decimal(value))]
    assert evaluate(rules.rfm_segment, "r int, f bigint, v decimal(28,2)", row) == [segment]


def test_revenue_colour_has_gaps_between_bands(evaluate):
    revenue = [
        "0.00", "0.01", "1500000.00", "1500000.50", "1500001.00", "3000000.00", "3000000.50", "3000001.00",
        "5000000.00", "5000000.01",
    ]
    rows = [(Decimal(amount),) for amount in revenue]
    assert evaluate(rules.revenue_colour, "v decimal(18,2)", rows) == [
        "88BFE0", "88BFE0", "88BFE0", "CACFD3", "FCED9F", "FCED9F", "CACFD3", "ED9A93", "ED9A93", "CACFD3",
    ]


def test_null_condition_does_not_match(evaluate):
    rule = lambda x: first_match([(x > 1, "big"), (x.isNull(), "none")], "small")
    assert evaluate(rule, "x int", [(2,), (None,), (0,)]) == ["big", "none", "small"]


def test_instant_is_wall_clock_time_of_the_session(spark):
    noon = dt.datetime(2001, 8, 2, 12)
    spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
    try:
        row = spark.range(1).select(
            F.hour(rules.instant(noon)), F.hour(rules.instant(noon.replace(tzinfo=dt.timezone.utc)))
        )
        assert tuple(row.first()) == (12, 7)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
