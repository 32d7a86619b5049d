"""Sorting, top-k and previews.

A range shuffle sends equal sort keys to one task. ``sort_rows`` takes tie-breakers, which divide a
hot key and make the order the same on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_rows(df: DataFrame, order: list[Column | str], ties: list[str]) -> DataFrame:
    """Total order: ``order`` first, then ``ties`` ascending."""
    return df.orderBy(*order, *ties)


def top_k(df: DataFrame, order: list[Column | str], ties: list[str], k: int) -> DataFrame:
    """First k rows of that order; each task keeps k rows, so nothing is sorted as a whole."""
    return df.orderBy(*order, *ties).limit(k)


def sort_by_length(df: DataFrame, column: str, ties: list[str]) -> DataFrame:
    """Shortest text first, then alphabetical."""
    return df.orderBy(F.length(column), column, *ties)


def having_top_k(
    df: DataFrame,
    key: str,
    aggregates: list[Column],
    having: str | Column,
    order: list[Column],
    k: int,
) -> DataFrame:
    """Grouped aggregates, kept where ``having`` holds, best k of them."""
    return top_k(df.groupBy(key).agg(*aggregates).filter(having), order, [key], k)
