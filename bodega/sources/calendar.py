"""Generated days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def days_between(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One ``fecha`` per day, both ends included."""
    bounds = spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))
    return _exploded(bounds)


def days_covering(df: DataFrame, moment: str) -> DataFrame:
    """One ``fecha`` per day from the earliest to the latest ``moment`` of ``df``, gaps included."""
    day = F.to_date(moment)
    return _exploded(df.agg(F.min(day).alias("first"), F.max(day).alias("last")))


def _exploded(bounds: DataFrame) -> DataFrame:
    return bounds.select(F.explode(F.sequence("first", "last")).alias("fecha"))
