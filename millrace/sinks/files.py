"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options: str) -> None:
    df.write.mode(mode).options(**options).csv(path)


def write_partitioned(
    df: DataFrame, path: str, by: list[str], mode: str = "overwrite", rebalance: bool = True
) -> None:
    """Parquet in one directory per value of ``by``.

    Rebalancing brings rows of a directory together, so that a thousand tasks do not write a
    thousand small files into each; adaptive execution then divides the directory of a hot value
    over several tasks.
    """
    rows = df.hint("rebalance", *by) if rebalance else df
    rows.write.mode(mode).partitionBy(*by).parquet(path)
