"""Report queries over the TPC-H-shaped tables, the bronze tables and the gold marts.

Where a report's result order leaves ties, the remaining output columns break them. That makes the limit
reports repeatable and lets the final range shuffle cut a single busy date into several tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.functions import rules
from bodega.plans.silver import COMPLETED

# Fixed values of the stock report definitions; every one can be replaced by an argument.
REVENUE_NATIONS = (
    "ARGENTINA", "UNITED KINGDOM", "FRANCE", "BRAZIL", "CHINA", "UNITED STATES", "JAPAN", "JORDAN",
)
PRIORITY_AFTER, PRIORITY_BEFORE = dt.date(1994, 1, 1), dt.date(1994, 1, 31)
TOP_CUSTOMERS = 400
RECENT_ROWS = 5


# --- orders and customers ---


def orders_customers(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderdate", "o_custkey")


def returns(lineitem: DataFrame) -> DataFrame:
    """Lines and returned lines per ship date and supplier."""
    counts = lineitem.groupBy("l_shipdate", "l_suppkey").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(F.col("l_returnflag") == "R").alias("return_count"),
    )
    return counts.orderBy("l_shipdate", "l_suppkey")


def supplier_count(supplier: DataFrame) -> DataFrame:
    return supplier.agg(F.count_distinct("s_suppkey").alias("num_suppliers"))


def orders_by_priority(orders: DataFrame, lineitem: DataFrame, mode: str = "l_shipmode") -> DataFrame:
    """Lines per order priority, shipping mode and order date; ``mode`` names the line column to use.

    Lines are counted per order and mode before they meet the orders, so a busy order is one row for each task.
    """
    per_order = lineitem.groupBy("l_orderkey", mode).agg(F.count(F.lit(1)).alias("lines"))
    joined = per_order.join(orders.select("o_orderkey", "o_orderpriority", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    counts = joined.groupBy(
        F.col("o_orderpriority").alias("priority"), F.col(mode).alias("ship_mode"), "o_orderdate"
    ).agg(F.sum("lines").alias("order_count"))
    return counts.orderBy("priority", "ship_mode", "o_orderdate")


def revenue_by_nation(
    customer: DataFrame,
    orders: DataFrame,
    lineitem: DataFrame,
    nation: DataFrame,
    nations: Sequence[str] = REVENUE_NATIONS,
) -> DataFrame:
    """Discounted revenue per order date and customer nation, weighted by name length and year.

    The weight, (name length + year - 1993) / 100, is the same for a whole group, so it is applied once to
    the group's sum. The joins go from the few chosen nations outwards to the lines.
    """
    chosen = nation.filter(F.col("n_name").isin(*nations))
    buyers = customer.join(chosen, customer.c_nationkey == chosen.n_nationkey)
    bought = orders.join(buyers, orders.o_custkey == buyers.c_custkey)
    joined = lineitem.join(bought, lineitem.l_orderkey == bought.o_orderkey)
    net = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net")
    sums = joined.groupBy("o_orderdate", F.col("n_name").alias("nation")).agg(net)
    weight = F.length("nation") + F.year("o_orderdate") - 1993
    revenue = (F.col("net") * weight * F.lit("0.01").cast("decimal(2,2)")).alias("revenue")
    return sums.select("o_orderdate", "nation", revenue).orderBy("nation", "o_orderdate")


def revenue_by_priority(
    orders: DataFrame, after: dt.date = PRIORITY_AFTER, before: dt.date = PRIORITY_BEFORE
) -> DataFrame:
    """Order value per date and priority strictly between two dates."""
    date = F.col("o_orderdate")
    chosen = orders.filter((date > F.lit(after)) & (date < F.lit(before)))
    sums = chosen.groupBy(date.alias("Date"), F.col("o_orderpriority").alias("Priority")).agg(
        F.sum("o_totalprice").alias("Total Price")
    )
    return sums.orderBy("Date", "Priority")


def top_customers(orders: DataFrame, customer: DataFrame, region: DataFrame, rows: int = TOP_CUSTOMERS) -> DataFrame:
    """The first ``rows`` customers by id with their revenue as a coloured label.

    The region only restricts: a customer stays when its nation key is also a region key.
    """
    per_customer = orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.sum("o_totalprice").alias("revenue")
    )
    buyers = customer.join(region, customer.c_nationkey == region.r_regionkey)
    joined = per_customer.filter("revenue > 0").join(buyers, F.col("customer_id") == F.col("c_custkey"))
    revenue = F.col("revenue")
    label = F.concat(
        F.lit('<div style="background-color:#'),
        rules.revenue_colour(revenue),
        F.lit('; text-align:center;"> $'),
        F.format_number(revenue, 0),
        F.lit("</div>"),
    )
    labelled = joined.select(
        F.col("customer_id").alias("Customer ID #"),
        F.col("c_mktsegment").alias("Customer Segment"),
        label.alias("Total Customer Revenue"),
    )
    return labelled.orderBy("Customer ID #", "Customer Segment", "Total Customer Revenue").limit(rows)


# --- tiles over the marts ---


def weekly_dayparts(kpis: DataFrame) -> DataFrame:
    """Sales per day part and week; weeks start on Monday."""
    week = F.date_trunc("week", "fecha_key").cast("date").alias("semana")
    parts = ("ventas_manana", "ventas_tarde", "ventas_noche")
    return kpis.groupBy(week).agg(*[F.sum(part).alias(part) for part in parts]).orderBy("semana")


def daily_transactions(kpis: DataFrame) -> DataFrame:
    day = F.date_trunc("day", "fecha_key").cast("date").alias("dia")
    return kpis.groupBy(day).agg(F.sum("numero_transacciones").alias("transacciones")).orderBy("dia")


def items_by_period(sales: DataFrame) -> DataFrame:
    """Items sold per day part, best first."""
    sums = sales.groupBy("periodo_dia").agg(F.sum("cantidad_total_items").alias("items"))
    return sums.orderBy(F.col("items").desc(), "periodo_dia")


def total_revenue(products: DataFrame) -> DataFrame:
    return products.agg(F.sum("ingresos_totales").alias("ingresos_totales"))


# --- quick looks at the sources ---


def recent_daily_sales(ventas: DataFrame, rows: int = RECENT_ROWS) -> DataFrame:
    """The latest days with completed sales."""
    completed = ventas.filter(F.col("estatus") == COMPLETED)
    days = completed.groupBy(F.to_date("fecha_hora").alias("fecha")).agg(
        F.count(F.lit(1)).alias("num_ventas"), F.sum("total").alias("total_ventas")
    )
    return days.orderBy(F.col("fecha").desc()).limit(rows)


def recent_purchase_orders(ordenes: DataFrame, rows: int = RECENT_ROWS) -> DataFrame:
    """Purchase orders per day and state, latest first."""
    days = ordenes.groupBy(F.to_date("fecha_orden").alias("fecha"), "estado").agg(
        F.count(F.lit(1)).alias("num_ordenes"), F.sum("total").alias("total_ordenes")
    )
    return days.orderBy(F.col("fecha").desc(), "estado").limit(rows)


def active_branch_count(sucursales: DataFrame) -> DataFrame:
    return sucursales.filter("activa").agg(F.count(F.lit(1)).alias("total_sucursales"))


def active_supplier_count(proveedores: DataFrame) -> DataFrame:
    return proveedores.filter("activo").agg(F.count(F.lit(1)).alias("total_proveedores"))


# --- day parts of other timed tables ---


def events_by_period(events: DataFrame) -> DataFrame:
    """Events, and those at a weekend, per day part and event type."""
    return events.groupBy(rules.day_part(F.col("ts")).alias("periodo_dia"), "event_type").agg(
        F.count(F.lit(1)).alias("eventos"), F.count_if(rules.is_weekend(F.col("ts"))).alias("en_fin_de_semana")
    )
