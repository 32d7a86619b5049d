"""Starting, waiting for and reading back streaming queries.

Every query has a checkpoint folder of its own, which is never deleted: started again with the same
folder, it goes on where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.numbering import numbered
from millrace.session import SHUFFLE_PARTITIONS, session_settings

HOURS = 3600

# State on local disk, backed up to the checkpoint folder, instead of on the executor's heap.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start(
    df: DataFrame,
    fmt: str,
    mode: str,
    checkpoint: str | None,
    every: str | None,
    name: str | None,
    by: tuple[str, ...] = (),
    **options,
) -> StreamingQuery:
    writer = df.writeStream.format(fmt).outputMode(mode).options(**options)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    if by:
        writer = writer.partitionBy(*by)
    return writer.start()


def to_console(
    df: DataFrame,
    mode: str,
    checkpoint: str | None = None,
    every: str | None = None,
    name: str | None = None,
    rows: int = 20,
) -> StreamingQuery:
    """Print each micro-batch. The console sink takes it through the driver: for small results."""
    return _start(df, "console", mode, checkpoint, every, name, numRows=rows, truncate=False)


def to_parquet(
    df: DataFrame,
    path: str,
    checkpoint: str,
    by: tuple[str, ...] = (),
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append new rows to Parquet, once each, in one directory per value of ``by``.

    ``every`` is a micro-batch interval such as ``"2 seconds"``; without it the query reads what
    there is, in as many micro-batches as the source allows, and ends.
    """
    return _start(df, "parquet", "append", checkpoint, every, name, by, path=path)


def to_state(
    df: DataFrame,
    checkpoint: str,
    mode: str = "update",
    every: str | None = None,
    name: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Keep a running aggregate as the query's own state, to be read with ``read_state``.

    The whole result stays distributed and takes no second copy; the sink discards what each trigger
    emits, by default the changed rows only. State may outgrow memory: it is kept in RocksDB. ``partitions`` is fixed by the first
    start for the life of the checkpoint; by default it is the session's. A query takes its settings
    when it starts, so the session's own are put back afterwards.
    """
    settings = {STATE_STORE: ROCKSDB}
    if partitions is not None:
        settings[SHUFFLE_PARTITIONS] = str(partitions)
    with session_settings(df.sparkSession, settings):
        return _start(df, "noop", mode, checkpoint, every, name)


def to_versions(
    df: DataFrame,
    path: str,
    checkpoint: str,
    order: list[str],
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Write the complete result of each trigger as a table of its own, a ``version`` below ``path``,
    with the ``position`` of each row by ``order``. A trigger that runs again writes its version again.

    Positions are counted over sorted ranges, so the result may be of any size; each trigger writes all of it.
    """

    def write(batch: DataFrame, version: int) -> None:
        placed = numbered(batch, order, "position").withColumn("position", F.col("position") + 1)
        placed.write.mode("overwrite").parquet(f"{path}/version={version}")

    writer = df.writeStream.foreachBatch(write).outputMode("complete").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return (writer.queryName(name) if name is not None else writer).start()


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The last version that ``to_versions`` wrote."""
    versions = spark.read.parquet(path)
    last = versions.agg(F.max("version")).first()[0]
    return versions.filter(F.col("version") == F.lit(last)).drop("version")


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Current result of a running aggregate: its keys and values, straight from the state store."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.*", "value.*")


def finish(query: StreamingQuery, timeout: int = 12 * HOURS) -> StreamingQuery:
    """Wait for a query to end. One that does not is stopped and reported."""
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} still runs after {timeout} s")
    return query


def finish_any(spark: SparkSession, timeout: int = 12 * HOURS) -> bool:
    """Wait until one of the session's queries ends; False when none did in time. A query that ended
    earlier counts until ``spark.streams.resetTerminated``."""
    return bool(spark.streams.awaitAnyTermination(timeout))
