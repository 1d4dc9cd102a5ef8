"""Insert new rows and replace matching ones, with the rules of SQL ``MERGE``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class AmbiguousUpdate(ValueError):
    """Several update rows match the same target row."""


def merged(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with ``updates`` applied: every matching row replaced, every other update row added.

    Keys compare with plain equality, so a NULL key matches nothing and is always added.
    """
    return target.join(updates.select(*keys), list(keys), "left_anti").unionByName(updates.select(*target.columns))


def require_unambiguous(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a target row has more than one update. Repeated keys that match nothing are allowed.

    Keys are counted first, so only the repeated ones are looked up in the target.
    """
    repeated = updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    example = target.select(*keys).join(repeated.select(*keys), list(keys), "left_semi").first()
    if example is not None:
        raise AmbiguousUpdate(f"several update rows for {example.asDict()}")
