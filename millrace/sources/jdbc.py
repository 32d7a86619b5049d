"""Database tables over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Jdbc:
    """Connection of a database. User and password come from the caller's environment."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def options(self, table: str) -> dict[str, str]:
        chosen = {"url": self.url, "driver": self.driver, "dbtable": table, **self.extra}
        if self.user is not None:
            chosen["user"] = self.user
        if self.password is not None:
            chosen["password"] = self.password
        return chosen


def split_options(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Options that read a table in ranges of a numeric column, one task and connection for each.

    The bounds only place the cuts; rows outside them are read by the first and the last task.
    """
    if upper <= lower or partitions < 1:
        raise ValueError("need lower < upper and at least one partition")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_table(
    spark: SparkSession,
    db: Jdbc,
    table: str,
    split: dict[str, str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Table as a DataFrame; without ``split`` a single task reads all of it."""
    options = {**db.options(table), "fetchsize": str(fetch_size), **(split or {})}
    return spark.read.format("jdbc").options(**options).load()
