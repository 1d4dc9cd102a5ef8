"""Places of rows in the order of their group, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bodega.llm.shared import store


def placed(df: DataFrame, group: str, order: Sequence[str], label: str) -> DataFrame:
    """``df`` with ``place`` (from 0, in the order of ``order``, nulls first) and ``total`` of its ``group``.

    Rows are dealt to ranges of (group, order), sorted there and written once; a row's place is the number of its
    group's rows in earlier ranges plus its place in its own. The running number of a row breaks ties, so that ranges
    cut through a group, and through any number of equal rows, wherever they have to.
    """
    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    keys = [group, *order, "_tie"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    rows = store(rows.withColumn("_at", F.monotonically_increasing_id()), label)
    rows = rows.withColumn("_range", F.shiftright("_at", 33))
    begins = rows.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(group)
    begins = begins.select(
        group,
        "_range",
        "_first",
        (F.sum("_rows").over(whole.orderBy("_range")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(whole).alias("total"),
    )
    place = (F.col("_at") - F.col("_first") + F.col("_before")).alias("place")
    return rows.join(begins, [group, "_range"]).select(*df.columns, place, "total")
