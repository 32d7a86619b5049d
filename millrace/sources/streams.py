"""Unbounded sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "text",
    max_files: int | None = None,
) -> DataFrame:
    """Files as they arrive in a directory or match a pattern; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket as column ``value``; not replayable, for trials only."""
    return spark.readStream.format("socket").options(host=host, port=port).load()


def kafka_options(servers: str, topic: str, max_offsets: int | None = None) -> dict[str, str]:
    chosen = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if max_offsets is not None:
        chosen["maxOffsetsPerTrigger"] = str(max_offsets)
    return chosen


def stream_kafka(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None
) -> DataFrame:
    """Records of a topic. Needs the Kafka connector, loaded through the session's ``packages``."""
    options = kafka_options(servers, topic, max_offsets)
    return spark.readStream.format("kafka").options(**options).load()


def decode_value(records: DataFrame, *keep: str) -> DataFrame:
    """Kafka-shaped records with ``value`` as text; ``keep`` names other columns to carry."""
    return records.selectExpr(*keep, "CAST(value AS STRING) AS value")
