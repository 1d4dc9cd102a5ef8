"""What Spark makes of the plans: pushed filters, pruned columns, shuffles, hot keys."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from conftest import AS_OF, RUN_TS, SMALL
from pyspark.sql import functions as F

from bodega.contract import registry
from bodega.operators.dedup import one_per_key
from bodega.plans import gold, reports, silver
from bodega.schemas import spec_of
from bodega.session import materialise, scale_settings, shared_folder
from bodega.sources.tpch import TpchTables


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def scan_of(df) -> str:
    """The details of the scans, which the plain plan cuts off."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def bronze_files(spark, tmp_path_factory):
    """Bronze ventas and detalle as stored parquet."""
    root = tmp_path_factory.mktemp("bronze")
    tables = TpchTables(spark, SMALL)
    stored = {}
    for name in ("ventas", "detalle_ventas", "productos"):
        tables.bronze(name).write.parquet(f"{root}/{name}")
        stored[name] = spark.read.schema(spec_of(f"bronze.{name}").ddl).parquet(f"{root}/{name}")
    return stored


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_silver_filters_and_columns_reach_the_scan(bronze_files):
    plan = scan_of(silver.ventas(bronze_files["ventas"]))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "EqualTo(estatus,completada)" in pushed and "GreaterThan(total,0.00)" in pushed
    assert "IsNotNull(fecha_hora)" in pushed
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert "folio" not in schema and "descuento" not in schema


def test_dedup_prunes_before_the_shuffle(bronze_files):
    plan = plan_of(silver.ventas(bronze_files["ventas"]))
    physical = plan.split("== Physical Plan ==")[1]
    below_shuffle = physical.split("Exchange hashpartitioning(id")[1]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle
    assert physical.count("Exchange") == 1


def test_hot_id_sends_one_row_per_task_through_the_shuffle(spark):
    rows = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("k"))
    df = one_per_key(rows.withColumn("v", F.rand(3)), ["k"])
    df.collect()
    final = df._jdf.queryExecution().executedPlan()
    assert "WindowGroupLimit" in final.toString()
    assert df.count() == 10_001


@pytest.mark.parametrize("query", [registry.detalle_enriquecido, registry.fact_inventario])
def test_product_lookup_comes_straight_from_two_shuffles(spark, no_broadcast, query):
    """The shape AQE needs to cut up a hot product."""
    join = plan_of(query(TpchTables(spark, SMALL))).split("== Physical Plan ==")[1].split("SortMergeJoin [producto_")[1]
    sides = re.split(r"\n +\+- Sort|\n +:- Sort", join)[1:3]
    for side in sides:
        below = side.split("\n")[1]
        assert "Exchange hashpartitioning(producto_" in below, below


def test_sales_join_needs_no_second_shuffle_of_either_side(bronze_files, no_broadcast):
    sales = silver.ventas(bronze_files["ventas"])
    lines = silver.detalle_ventas(bronze_files["detalle_ventas"])
    products = silver.productos(bronze_files["productos"])
    per_sale = gold.line_rollup(gold.lines_with_margin(lines, products))
    physical = plan_of(gold.fact_ventas(sales, per_sale, RUN_TS)).split("== Physical Plan ==")[1]
    # one each for the three dedups, one for the margin lookup, one for the rollup; the join on the sale adds none
    assert physical.count("Exchange hashpartitioning") == 5


def test_products_are_added_up_before_the_margin_join(bronze_files, no_broadcast):
    lines = silver.detalle_ventas(bronze_files["detalle_ventas"])
    products = silver.productos(bronze_files["productos"])
    physical = plan_of(gold.rendimiento_productos(lines, products)).split("== Physical Plan ==")[1]
    assert physical.index("SortMergeJoin") < physical.index("HashAggregate")


def test_no_query_multiplies_tables(spark):
    for name in ("bi_revenue_by_nation", "bi_top_customers", "kpis_diarios", "fact_inventario", "silver_clientes"):
        plan = plan_of(registry.queries()[name](spark, SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_no_python_in_any_plan(spark):
    tables = TpchTables(spark, SMALL)
    for query in (registry.kpis_diarios, registry.rfm_clientes, registry.alertas_inventario, registry.dim_tiempo):
        assert "Python" not in plan_of(query(tables))


def test_report_filters_reach_the_scan(spark):
    orders = TpchTables(spark, SMALL).raw("orders")
    plan = scan_of(reports.revenue_by_priority(orders, dt.date(1996, 1, 1), dt.date(1996, 2, 1)))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(o_orderdate.*LessThan\(o_orderdate", plan)


def test_adaptive_execution_cuts_up_a_hot_product(spark, no_broadcast):
    """A third of the lines on one product, with thresholds scaled down to the size of the test."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        lines = spark.range(0, 60_000, 1, 8).select(
            F.col("id").alias("detalle_id"),
            (F.col("id") % 5000).alias("venta_id"),
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 900).alias("producto_id"),
            F.lit(1).cast("decimal(10,3)").alias("cantidad"),
            F.lit(2).cast("decimal(12,2)").alias("subtotal"),
        )
        products = spark.range(900).select(
            F.col("id").alias("producto_id"), F.lit(50).cast("decimal(10,2)").alias("margen")
        )
        rollup = gold.line_rollup(gold.lines_with_margin(lines, products))
        rows = rollup.collect()
        assert "skew=true" in rollup._jdf.queryExecution().executedPlan().toString()
        assert len(rows) == 5000 and {row.margen_total for row in rows} == {12}
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_materialised_frame_has_no_lineage(spark):
    df = materialise(spark.range(10).withColumn("d", F.lit(AS_OF)), "test")
    assert "Range" not in plan_of(df) and df.count() == 10 and df.dtypes == [("id", "bigint"), ("d", "date")]


def test_shared_folder_is_the_one_the_cluster_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == (named.rstrip("/") if named else folder) and shared_folder(spark) == folder


def test_shuffle_width_follows_the_input():
    def width(size):
        return int(scale_settings(size)["spark.sql.shuffle.partitions"])

    assert (width(1 << 30), width(1 << 40), width(100 << 40)) == (4, 4096, 409_600)
