"""Null profile and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_nulls(df: DataFrame) -> DataFrame:
    """Number of nulls of each column, as one row, in one pass."""
    return df.select([F.count_if(F.isnull(F.col(f"`{c}`"))).alias(c) for c in df.columns])


def null_profile(df: DataFrame) -> DataFrame:
    """The same counts as rows ``(column_name, nulls)``."""
    counts = count_nulls(df)
    return counts.unpivot([], [f"`{c}`" for c in counts.columns], "column_name", "nulls")


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=subset)


def fill_nulls(df: DataFrame, values: dict) -> DataFrame:
    """Fill nulls per column; a value of another type takes the column's type (0 becomes "0")."""
    return df.na.fill(values)
