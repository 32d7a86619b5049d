"""Feature columns and splits."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.numbering import numbered_keys, with_numbers

_STEPS = 1_000_000
# Leading hexadecimal digits of the hash that make the draw.
_DIGITS = 12


def assemble(df: DataFrame, columns: list[str], name: str = "features") -> DataFrame:
    """Numeric columns as one vector column."""
    return VectorAssembler(inputCols=columns, outputCol=name).transform(df)


def index_labels(df: DataFrame, column: str, name: str = "label") -> DataFrame:
    """Text labels as numbers from 0.0, the most frequent first, ties alphabetical. Labels are numbered and
    joined as tables of any size; a NULL label has no number."""
    numbers = numbered_keys(df, column, name, by_frequency=True)
    return with_numbers(df, numbers.withColumn(name, F.col(name).cast("double")), column).select(*df.columns, name)


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Split by a seeded draw per row; the outcome depends on how rows are partitioned."""
    return df.randomSplit(weights, seed)


def hash_split(df: DataFrame, keys: list[str], weights: list[float], seed: int) -> list[DataFrame]:
    """Split by a hash of the keys: disjoint, complete, and the same for any partitioning.

    The draw is the MD5 of seed and keys as text, parted by bars, so any other engine can repeat it.

    Copies of a key stay on one side, so no test row has been seen in training. Nothing is cached
    or sorted; each part is a filter.
    """
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), 1, _DIGITS)
    draw = F.conv(digits, 16, 10).cast("bigint") % _STEPS
    total, reached, parts = sum(weights), 0.0, []
    for weight in weights:
        low, reached = round(reached / total * _STEPS), reached + weight
        high = round(reached / total * _STEPS)
        parts.append(df.filter((draw >= low) & (draw < high)))
    return parts
