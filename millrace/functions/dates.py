"""Text to dates and times. Unreadable text gives NULL, also in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(column: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.try_to_timestamp(column, F.lit(pattern)).cast("date")


def parse_timestamp(column: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.try_to_timestamp(column, F.lit(pattern))
