"""Session helper: one builder for a laptop, a standalone cluster or a managed cluster."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
ADAPTIVE_ENABLED = "spark.sql.adaptive.enabled"

# Adaptive execution sizes shuffles, turns joins into broadcasts when the measured side is small
# and splits skewed join partitions, also where that costs one more exchange.
ADAPTIVE = {
    ADAPTIVE_ENABLED: "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Partitions that a shuffle starts with where the caller names no number; adaptive execution merges
# them to the advised size, but never divides an aggregate's.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
STARTS_WITH = 8_000

# Rows of a partition: few enough to sort in memory; small data is still spread over all cores.
ROWS_PER_PARTITION = 1_000_000
LEAST_ROWS = 50_000


def build_session(
    app_name: str,
    master: str | None = None,
    jars: str | None = None,
    packages: str | None = None,
    shuffle_partitions: int | None = None,
    py_files: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session.

    ``master`` stays unset on a managed cluster, where the launcher names it. Without
    ``shuffle_partitions`` a shuffle starts with ``STARTS_WITH`` partitions, which adaptive execution
    merges; set ``INITIAL_PARTITIONS`` in ``conf`` where a shuffle holds far more than a terabyte. ``jars`` and ``packages`` load connectors; ``py_files`` ships helper modules to workers.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = dict(ADAPTIVE)
    if jars is not None:
        settings["spark.jars"] = jars
    if packages is not None:
        settings["spark.jars.packages"] = packages
    if py_files is not None:
        settings["spark.submit.pyFiles"] = py_files
    if shuffle_partitions is not None:
        settings[SHUFFLE_PARTITIONS] = str(shuffle_partitions)
    else:
        settings[INITIAL_PARTITIONS] = str(STARTS_WITH)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session for the jobs and streams started inside, put back afterwards."""
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Number of partitions for data that stays partitioned, where adaptive execution cannot choose."""
    cores = spark.sparkContext.defaultParallelism
    return max(min(cores, -(-rows // LEAST_ROWS)), -(-rows // ROWS_PER_PARTITION), 1)
