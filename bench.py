"""Time the registered queries and print one JSON line.

A few queries run first to warm the JVM; then each runs once. Results go to Spark's ``noop`` sink, so every row
is computed and none is kept. ``pipeline`` times one full refresh by layer, all 26 tables written as declared.
"""

from __future__ import annotations

import json
import os
import sys
import time

from bodega.contract import registry
from bodega.plans import pipeline
from bodega.session import build_session, scratch_path
from bodega.sinks.warehouse import Warehouse
from bodega.sources.tpch import AS_OF, COLUMNS, RUN_TS, TpchTables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UP = ("bi_revenue_by_nation", "kpis_diarios", "ingest_summary")


def timed(query, spark) -> float:
    started = time.perf_counter()
    query(spark, FOLDER).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def refresh(spark) -> dict[str, float]:
    warehouse = Warehouse(spark, scratch_path(spark, "bench"), "bench_")
    warehouse.create()
    run = pipeline.Run(AS_OF, RUN_TS)
    layers = {
        "ingest": lambda: pipeline.to_bronze(warehouse, TpchTables(spark, FOLDER).source, COLUMNS, run),
        "silver": lambda: pipeline.to_silver(warehouse, run),
        "gold": lambda: pipeline.to_gold(warehouse, run),
    }
    seconds = {}
    for layer, step in layers.items():
        started = time.perf_counter()
        step()
        seconds[layer] = round(time.perf_counter() - started, 3)
    return seconds


def main(names: list[str]) -> None:
    settings = {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("bodega-bench", f"local[{CPUS}]", settings)
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    for name in WARM_UP:
        timed(queries[name], spark)
    seconds = {name: timed(query, spark) for name, query in queries.items() if not names or name in names}
    result = {
        "metric": "total time of all registered queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "pipeline": {} if names else refresh(spark),
        "sf": os.path.basename(FOLDER.rstrip("/")),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main(sys.argv[1:])
