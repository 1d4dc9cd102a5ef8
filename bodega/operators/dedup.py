"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def one_per_key(df: DataFrame, keys: Sequence[str], newest_by: str | None = None) -> DataFrame:
    """Keep one row per key: the newest, then the smallest by all other columns.

    The order covers every column, so rows that still tie are identical and the result does not
    depend on partitioning. NULL keys form one group. Spark keeps only the best row per key within
    each map task before the shuffle, so a hot key sends one row per task.
    """
    others = [name for name in df.columns if name not in keys and name != newest_by]
    order = [F.col(newest_by).desc_nulls_last()] if newest_by else []
    order += [F.col(name).asc_nulls_first() for name in others]
    ranked = Window.partitionBy(*keys).orderBy(*(order or [F.lit(0)]))
    return df.withColumn(_RANK, F.row_number().over(ranked)).filter(F.col(_RANK) == 1).drop(_RANK)
