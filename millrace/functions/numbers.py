"""Numeric columns: buckets, scores and sums of one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(rules: list[tuple[Column, str]], default: str | None = None) -> Column:
    """Label of the first rule that holds. Without a default, NULL and uncovered values stay NULL;
    with one they take it."""
    (condition, label), *rest = rules
    labelled = F.when(condition, label)
    for condition, label in rest:
        labelled = labelled.when(condition, label)
    return labelled if default is None else labelled.otherwise(F.lit(default))


def in_bucket(rules: list[tuple[Column, str]], label: str) -> Column:
    """Whether ``bucket`` gives this label. Unlike a comparison of the label, the condition of the
    rule itself reaches the scan."""
    position = [name for _, name in rules].index(label)
    holds = rules[position][0]
    for condition, _ in rules[:position]:
        holds = holds & ~F.coalesce(condition, F.lit(False))
    return holds


def weighted_score(rating: Column, reviews: Column) -> Column:
    """Rating weighted by the natural logarithm of the number of reviews (not rounded)."""
    return rating * F.log(reviews)


def square(column: Column) -> Column:
    """``x * x``: integers stay integers."""
    return column * column


def row_sum(*columns: Column) -> Column:
    """Sum of any number of columns of one row."""
    return reduce(lambda total, column: total + column, columns)
