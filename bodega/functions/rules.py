"""The business rules. Each takes columns (and the as-of date where time matters) and gives a column.

No rule reads the clock: "today" is always the ``as_of`` argument, so a rerun gives the same labels.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from bodega.functions.ladders import below, first_match, lookup

# Thresholds and labels that stored tables and reports depend on.
DAY_PARTS = ((6, 11, "Mañana"), (12, 17, "Tarde"))
NIGHT = "Noche"
WEEKEND_DAYS = (1, 7)
TENURE_BANDS = ((90, "Nuevo"), (365, "Regular"))
TENURE_REST = "Antiguo"
CREDIT_RANKS = {"VIP": 3, "Regular": 2}
CREDIT_RANK_REST = 1
NO_EXPIRY_DAYS = 999
EXPIRY_BANDS = ((7, "Critico"), (30, "Alerta"), (90, "Normal"))
EXPIRY_REST = "Optimo"
OUT_OF_STOCK, LOW_STOCK, STOCK_OK = "Sin Stock", "Stock Bajo", "Stock OK"
LOW_STOCK_LIMIT = 10
# label, recency below, frequency above, value above
RFM_TIERS = (
    ("Champions", 30, 10, 1_000_000),
    ("Leales", 60, 5, None),
    ("Potenciales", 90, 2, None),
)
RFM_LAPSED_AFTER, RFM_LAPSED = 180, "En Riesgo"
RFM_REST = "Regulares"
URGENT_STATES = ("Critico", "Alerta")
CLEARANCE_BANDS = ((7, "Liquidar urgente"), (15, "Promocionar"))
RESTOCK_ACTIONS = {OUT_OF_STOCK: "Reabastecer urgente", LOW_STOCK: "Reabastecer"}
NO_ACTION = "Monitorear"
HIGH_SEASON, MID_SEASON = (12, 1, 6, 7), (2, 3, 8, 9)
REVENUE_COLOURS = ((0, 1_500_000, "88BFE0"), (1_500_001, 3_000_000, "FCED9F"), (3_000_001, 5_000_000, "ED9A93"))
REVENUE_COLOUR_REST = "CACFD3"


def instant(at: dt.datetime) -> Column:
    """A fixed time. Without an offset of its own it is wall-clock time in the session's zone, not the driver's."""
    return F.lit(at.isoformat(" ")).cast("timestamp")


def day_part(moment: Column) -> Column:
    hour = F.hour(moment)
    return first_match(((hour.between(first, last), name) for first, last, name in DAY_PARTS), NIGHT)


def is_weekend(moment: Column) -> Column:
    return F.coalesce(F.dayofweek(moment).isin(*WEEKEND_DAYS), F.lit(False))


def day_type(day: Column) -> Column:
    return F.when(is_weekend(day), "Fin de Semana").otherwise("Entre Semana")


def season(day: Column) -> Column:
    month = F.month(day)
    return first_match([(month.isin(*HIGH_SEASON), "Alta"), (month.isin(*MID_SEASON), "Media")], "Baja")


def days_since(day: Column, as_of: dt.date) -> Column:
    return F.datediff(F.lit(as_of), day)


def tenure_segment(days: Column) -> Column:
    """An unknown registration date (NULL days) counts as an old customer."""
    return below(days, TENURE_BANDS, TENURE_REST)


def credit_rank(customer_type: Column) -> Column:
    return lookup(customer_type, CREDIT_RANKS, CREDIT_RANK_REST)


def margin_percent(price: Column, cost: Column) -> Column:
    """Margin on the sale price; the caller has already required a positive price."""
    return (price - cost) / price * 100


def days_to_expiry(expiry: Column, as_of: dt.date) -> Column:
    """Goods without an expiry date get a far-away sentinel that averages include."""
    return F.coalesce(F.datediff(expiry, F.lit(as_of)), F.lit(NO_EXPIRY_DAYS))


def expiry_state(days: Column) -> Column:
    """Expects the sentinel of ``days_to_expiry``. Goods already expired are critical too."""
    return below(days, EXPIRY_BANDS, EXPIRY_REST)


def stock_alert(quantity: Column) -> Column:
    return first_match([(quantity == 0, OUT_OF_STOCK), (quantity < LOW_STOCK_LIMIT, LOW_STOCK)], STOCK_OK)


def percent_of(amount: Column, percent: Column) -> Column:
    """Multiplying by 0.01 keeps the decimal exact and avoids a decimal division per row."""
    return amount * percent * F.lit("0.01").cast("decimal(2,2)")


def needs_action(state: Column, alert: Column) -> Column:
    """Low stock alone asks for no action; only near expiry or an empty shelf does."""
    return F.coalesce(state.isin(*URGENT_STATES), F.lit(False)) | F.coalesce(alert == OUT_OF_STOCK, F.lit(False))


def priority(state: Column, alert: Column) -> Column:
    high = (state == "Critico") | (alert == OUT_OF_STOCK)
    return first_match([(high, "Alta"), (state == "Alerta", "Media")], "Baja")


def recommended_action(days: Column, alert: Column) -> Column:
    """Selling off what is about to expire comes before restocking."""
    return below(days, CLEARANCE_BANDS, lookup(alert, RESTOCK_ACTIONS, NO_ACTION))


def rfm_segment(recency: Column, frequency: Column, value: Column) -> Column:
    steps = []
    for label, recent, often, rich in RFM_TIERS:
        tier = (recency < recent) & (frequency > often)
        steps.append((tier if rich is None else tier & (value > rich), label))
    steps.append((recency > RFM_LAPSED_AFTER, RFM_LAPSED))
    return first_match(steps, RFM_REST)


def revenue_colour(revenue: Column) -> Column:
    """The bands have gaps between whole numbers: 1,500,000.50 takes the last colour."""
    return first_match(((revenue.between(low, high), code) for low, high, code in REVENUE_COLOURS), REVENUE_COLOUR_REST)
