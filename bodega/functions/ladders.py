"""First-match-wins rules built from small tables of steps."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(steps: Iterable[tuple[Column, object]], otherwise: object) -> Column:
    """The value of the first step whose condition is true. A NULL condition does not match."""
    (condition, value), *rest = steps
    opened = F.when(condition, value)
    return reduce(lambda ladder, step: ladder.when(*step), rest, opened).otherwise(otherwise)


def below(measure: Column, bands: Iterable[tuple[int, str]], otherwise: str) -> Column:
    """The label of the first band whose upper limit (exclusive) lies above ``measure``."""
    return first_match(((measure < limit, label) for limit, label in bands), otherwise)


def lookup(key: Column, values: dict[str, object], otherwise: object) -> Column:
    """The value stored for an exact key."""
    return first_match(((key == name, value) for name, value in values.items()), otherwise)
