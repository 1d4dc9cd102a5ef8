from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from bodega.plans import reports


def test_customer_labels(spark):
    orders = spark.createDataFrame(
        [(1, Decimal("1500000.00")), (1, Decimal("0.50")), (2, Decimal("2000000.00")), (3, Decimal("0.00")),
         (4, Decimal("1234567.50")), (9, Decimal("10.00"))],
        "o_custkey bigint, o_totalprice decimal(18,2)",
    )
    customer = spark.createDataFrame(
        [(1, 0, "A"), (2, 1, "B"), (3, 0, "C"), (4, 1, "D"), (9, 7, "E")],
        "c_custkey bigint, c_nationkey int, c_mktsegment string",
    )
    region = spark.createDataFrame([(0,), (1,)], "r_regionkey int")
    rows = [tuple(row) for row in reports.top_customers(orders, customer, region).collect()]

    def label(colour, amount):
        return f'<div style="background-color:#{colour}; text-align:center;"> ${amount}</div>'

    # 3 has no revenue, 9 a nation key that is no region key; 1 falls into the gap between two bands
    assert rows == [
        (1, "A", label("CACFD3", "1,500,000")),
        (2, "B", label("FCED9F", "2,000,000")),
        (4, "D", label("88BFE0", "1,234,568")),
    ]
    assert [row[0] for row in reports.top_customers(orders, customer, region, rows=2).collect()] == [1, 2]


def test_priority_dates_are_exclusive(spark):
    days = [dt.datetime(1994, 1, day) for day in (1, 2, 30, 31)]
    orders = spark.createDataFrame(
        [(day, "1-URGENT", Decimal(1)) for day in days],
        "o_orderdate timestamp_ntz, o_orderpriority string, o_totalprice decimal(18,2)",
    )
    assert [row.Date for row in reports.revenue_by_priority(orders).collect()] == days[1:3]


def test_nation_weight(spark):
    customer = spark.createDataFrame([(1, 1), (2, 2)], "c_custkey bigint, c_nationkey int")
    nation = spark.createDataFrame([(1, "FRANCE"), (2, "PERU")], "n_nationkey int, n_name string")
    orders = spark.createDataFrame(
        [(10, 1, dt.datetime(1995, 5, 1)), (11, 2, dt.datetime(1995, 5, 1))],
        "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    )
    lineitem = spark.createDataFrame(
        [
            (10, Decimal("100.00"), Decimal("0.10")),
            (10, Decimal("10.00"), Decimal("0.00")),
            (11, Decimal("5.00"), Decimal("0.00")),
        ],
        "l_orderkey bigint, l_extendedprice decimal(12,2), l_discount decimal(4,2)",
    )
    (row,) = reports.revenue_by_nation(customer, orders, lineitem, nation).collect()
    # 100 * (6/100 + 2/100)
    assert (row.nation, row.revenue) == ("FRANCE", Decimal("8.000000"))


def test_ship_mode_column_is_the_default(spark):
    orders = spark.createDataFrame(
        [(1, "1-URGENT", dt.date(2000, 1, 1))], "o_orderkey int, o_orderpriority string, o_orderdate date"
    )
    lineitem = spark.createDataFrame([(1, "AIR"), (1, "AIR"), (1, "RAIL")], "l_orderkey int, l_shipmode string")
    rows = [tuple(row) for row in reports.orders_by_priority(orders, lineitem).collect()]
    assert rows == [("1-URGENT", "AIR", dt.date(2000, 1, 1), 2), ("1-URGENT", "RAIL", dt.date(2000, 1, 1), 1)]


def test_weeks_start_on_monday(spark):
    kpis = spark.createDataFrame(
        [(dt.date(2001, 8, 5), 1, 2, 3), (dt.date(2001, 8, 6), 10, 20, 30), (dt.date(2001, 8, 12), 1, 1, 1)],
        "fecha_key date, ventas_manana int, ventas_tarde int, ventas_noche int",
    )
    rows = [tuple(row) for row in reports.weekly_dayparts(kpis).collect()]
    assert rows == [(dt.date(2001, 7, 30), 1, 2, 3), (dt.date(2001, 8, 6), 11, 21, 31)]


def test_latest_days_come_first(spark):
    orders = spark.range(10).select(
        F.expr("date_add(date'2001-01-01', cast(id as int))").alias("fecha_orden"),
        F.lit("abierta").alias("estado"),
        F.lit(Decimal(2)).alias("total"),
    )
    both = orders.unionByName(orders.withColumn("estado", F.lit("cerrada")))
    rows = [(row.fecha.day, row.estado, row.num_ordenes) for row in reports.recent_purchase_orders(both).collect()]
    assert rows == [(10, "abierta", 1), (10, "cerrada", 1), (9, "abierta", 1), (9, "cerrada", 1), (8, "abierta", 1)]
