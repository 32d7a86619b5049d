"""Dense numbers for rows and keys, in a chosen order, without a task that sees them all.

Rows are sorted over ranges and written with their place inside their partition. One row per partition says
how many rows it holds; their running total, over as many rows as there are partitions, is what places are counted from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.scratch import materialize

# monotonically_increasing_id() holds the place within the partition below this bit.
_PLACE_BITS = 33
_PLACE = (1 << _PLACE_BITS) - 1


def _placed(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """The rows in order, written, with ``_part`` and ``_place``. Written, because a second run of the sort may
    cut its ranges elsewhere."""
    marked = df.orderBy(*order).withColumn("_mark", F.monotonically_increasing_id())
    part, place = F.shiftright("_mark", _PLACE_BITS), F.col("_mark").bitwiseAND(F.lit(_PLACE))
    return materialize(marked.select(*df.columns, part.alias("_part"), place.alias("_place")), "placed")


def _before(parts: DataFrame, *totals: str) -> DataFrame:
    """For each partition what ``totals`` are of those before it, as ``_<total>_before``."""
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return parts.select(
        "_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}_before") for c in totals]
    )


def numbered(df: DataFrame, order: list[Column | str], name: str = "number") -> DataFrame:
    """Rows with their place in ``order``, from 0. Rows that are equal in ``order`` come in any order, so
    add columns that tell them apart."""
    placed = _placed(df, order)
    parts = materialize(placed.groupBy("_part").agg(F.count("*").alias("rows")), "parts")
    return placed.join(_before(parts, "rows"), "_part").select(
        *df.columns, (F.col("_rows_before") + F.col("_place")).alias(name)
    )


def running_totals(df: DataFrame, order: list[Column | str], totals: dict[str, str]) -> DataFrame:
    """Rows with running totals in ``order``, each row's own value included: of the columns that
    ``totals`` names, as integers or doubles, under the names it gives. A window counts inside a partition, and
    what the partitions before it hold is added."""
    placed = _placed(df, order)
    sums = [F.sum(source).alias(f"_s{i}") for i, source in enumerate(totals)]
    parts = materialize(placed.groupBy("_part").agg(*sums), "parts")
    names = [f"_s{i}" for i in range(len(totals))]
    up_to_here = W.partitionBy("_part").orderBy("_place").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = [
        (F.coalesce(F.sum(source).over(up_to_here), F.lit(0)) + F.col(f"__s{i}_before")).alias(name)
        for i, (source, name) in enumerate(totals.items())
    ]
    return placed.join(_before(parts, *names), "_part").select(*df.columns, *running)


def numbered_keys(df: DataFrame, key: str, name: str = "number", by_frequency: bool = False) -> DataFrame:
    """One row per value of ``key`` that is not NULL, with a dense number from 0: in the order of the values or,
    ``by_frequency``, the most frequent first, ties in the order of the values."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    order = [F.desc("_n"), key] if by_frequency else [key]
    return numbered(counts, order, name).select(key, name)


def with_numbers(df: DataFrame, numbers: DataFrame, key: str) -> DataFrame:
    """Rows with the number of their key from ``numbered_keys``; NULL where the key has none."""
    return df.join(numbers, key, "left")
