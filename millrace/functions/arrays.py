"""Array columns, element by element."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_elements(column: Column, fn: Callable[[Column], Column]) -> Column:
    return F.transform(column, fn)


def keep_elements(column: Column, predicate: Callable[[Column], Column]) -> Column:
    return F.filter(column, predicate)


def sum_elements(column: Column) -> Column:
    """Sum of an integer array as bigint; 0 for an empty one."""
    return F.aggregate(column, F.lit(0).cast("bigint"), lambda total, x: total + x)
