"""Unions."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """By position, copies kept."""
    return first.union(second)


def union_distinct(first: DataFrame, second: DataFrame) -> DataFrame:
    """By position, each row once; copies collapse before the shuffle."""
    return first.union(second).distinct()


def union_by_name(first: DataFrame, second: DataFrame, fill_missing: bool = False) -> DataFrame:
    """By column name; with ``fill_missing``, columns that one side lacks are NULL there."""
    return first.unionByName(second, allowMissingColumns=fill_missing)
