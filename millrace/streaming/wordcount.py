"""Word count, the same for a table and a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import words


def word_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """Occurrences of each space-parted word. Counts combine per task before the shuffle, so a very
    frequent word costs one row per task; state grows with the vocabulary."""
    return (
        lines.select(F.explode(words(F.col(column))).alias("word")).groupBy("word").count()
    )
