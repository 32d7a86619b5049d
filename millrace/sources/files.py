"""Bounded files. A path is one file, a directory or a pattern, on any Hadoop file system."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
    delimiter: str = ",",
    **options: str,
) -> DataFrame:
    """CSV with a declared schema, so no pass over the data guesses one. Columns bind by position;
    a value that is not of its type becomes NULL. The delimiter may have several characters."""
    reader = spark.read.schema(schema).options(header=header, sep=delimiter, **options)
    return reader.csv(path)


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One row per file: path, modificationTime, length, content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)


def map_text(
    df: DataFrame, key: str, content: str, extract: Callable[[str], str], name: str = "text"
) -> DataFrame:
    """A Python function over one column, in Arrow batches inside the tasks of the scan.

    For extraction that no column expression can do. ``extract`` takes one value and gives text; it
    is shipped to the workers, nothing comes back to the driver, and there is no shuffle.
    """

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = [None if v is None else extract(v) for v in frame[content]]
            yield pd.DataFrame({key: frame[key], name: pd.Series(values, dtype="object")})

    schema = T.StructType([df.schema[key], T.StructField(name, T.StringType())])
    return df.select(key, content).mapInPandas(batches, schema)
