"""Equi-joins. No join is hinted.

Catalyst broadcasts a side whose statistics are under ``spark.sql.autoBroadcastJoinThreshold``,
adaptive execution does so for a side whose measured shuffle is, and every other side goes through a
sort-merge join whose skewed partitions adaptive execution splits. What it cannot split is the side
that an outer join may leave out: an order with a third of all lines, in orders left join lines. For
that, name the columns that tell such rows apart as ``spread``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.documents import json_text
from millrace.operators.skew import split_join


def join_using(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "inner",
    spread: list[str] | None = None,
    **skew,
) -> DataFrame:
    """Join on shared names: the key comes out once, from the side that is kept whole. With
    ``spread``, the right side may have hot keys."""
    if spread is None:
        return left.join(right, on=on, how=how)
    keys = [on] if isinstance(on, str) else on
    return split_join(left, right, keys, spread, how, "right", **skew)


def join_on(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    spread: list[str] | None = None,
    **skew,
) -> DataFrame:
    """Join on keys of different names: both come out. With ``spread``, the right side may have hot
    keys."""
    if spread is None:
        return left.join(right, F.col(left_key) == F.col(right_key), how)
    return split_join(left, right, [left_key], spread, how, "right", [right_key], **skew)


def star_join(
    fact: DataFrame,
    fact_json: str,
    fact_columns: list[str],
    dimensions: list[tuple[DataFrame, str, str, str]],
) -> DataFrame:
    """Fact rows with one name from each dimension, all kept in JSON text.

    ``dimensions`` holds ``(table, key column, JSON column, JSON field)``; the fact's JSON has a
    field named like each key column, all taken out in one parse. Keys are read as numbers on both
    sides; text that is none joins with nothing.
    """
    keys = [key for _, key, _, _ in dimensions]
    texts = fact.select(*fact_columns, F.json_tuple(fact_json, *keys).alias(*keys))
    result = texts.select(*fact_columns, *[F.col(key).try_cast("bigint").alias(key) for key in keys])
    for dimension, key, json_column, field in dimensions:
        names = dimension.select(
            F.col(key).cast("bigint").alias(key),
            json_text(F.col(json_column), f"$.{field}").alias(field),
        )
        result = result.join(names, key)
    return result.select(*fact_columns, *[field for _, _, _, field in dimensions])
