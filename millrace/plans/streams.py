"""Streaming queries that read what there is and end. Each has its own folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.registry import query
from millrace.plans.scalars import LOG_FIELDS, event_lines, log_columns, mixed_lines
from millrace.scratch import scratch_path
from millrace.session import partitions_for
from millrace.sources.streams import stream_files
from millrace.streaming.logs import LINE_SCHEMA, parse_lines, summarize
from millrace.streaming.run import finish, read_latest, read_state, to_parquet, to_state, to_versions
from millrace.streaming.wordcount import word_counts
from millrace.tables import table


# Files of one micro-batch: what is read again when a batch fails half-way.
FILES_PER_BATCH = 10_000

# Words of a document, roughly; only the number of state partitions depends on it.
WORDS = 100


def _log_folder(spark: SparkSession, sf: str) -> str:
    """Log lines as text files, one for each task that writes."""
    path = scratch_path(spark, "logs")
    mixed_lines(spark, sf).write.text(path)
    return path


def _parsed(spark: SparkSession, path: str) -> DataFrame:
    return parse_lines(stream_files(spark, path, LINE_SCHEMA, max_files=FILES_PER_BATCH))


@query(LOG_FIELDS)
def stream_log_parse(spark: SparkSession, sf: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "parsed"), scratch_path(spark, "checkpoint")
    parsed = _parsed(spark, _log_folder(spark, sf))
    finish(to_parquet(parsed, out, checkpoint))
    return log_columns(spark.read.schema(parsed.schema).parquet(out))


@query("""
    SELECT server, level, count(*) AS n, row_number() OVER (ORDER BY server, level) AS position
    FROM (SELECT 'server-node-' || (user_id % 5 + 1) AS server, upper(event_type) AS level FROM events)
    GROUP BY server, level
""")
def stream_log_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Running summary, sorted; the version that the last trigger wrote."""
    out, checkpoint = scratch_path(spark, "summary"), scratch_path(spark, "checkpoint")
    summary = summarize(_parsed(spark, _log_folder(spark, sf)))
    finish(to_versions(summary, out, checkpoint, ["server", "level"]))
    return read_latest(spark, out).withColumnRenamed("count", "n")


@query(LOG_FIELDS)
def stream_parquet_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "parsed"), scratch_path(spark, "checkpoint")
    parsed = _parsed(spark, _log_folder(spark, sf))
    finish(to_parquet(parsed, out, checkpoint, by=("server", "level")))
    return log_columns(spark.read.schema(parsed.schema).parquet(out))


@query("""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word
""")
def stream_word_count(spark: SparkSession, sf: str) -> DataFrame:
    """Running count over the documents as a stream; the pattern matches a file and a directory."""
    checkpoint = scratch_path(spark, "checkpoint")
    stored = table(spark, sf, "documents").select("doc_id", "text")
    schema, partitions = stored.schema, partitions_for(spark, stored.count() * WORDS)
    documents = stream_files(spark, f"{sf}/documents.parquet*", schema, "parquet", FILES_PER_BATCH)
    finish(to_state(word_counts(documents, "text"), checkpoint, partitions=partitions))
    return read_state(spark, checkpoint).withColumnRenamed("count", "n")


@query(LOG_FIELDS)
def stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """A stream stopped and started again over a folder that grows: every line arrives once."""
    logs, out, checkpoint = (scratch_path(spark, name) for name in ("logs", "parsed", "checkpoint"))
    lines = event_lines(spark, sf)
    first_half = F.col("value") < "2024-01-16"
    lines.filter(first_half).select("value").write.text(logs)
    finish(to_parquet(_parsed(spark, logs), out, checkpoint))
    lines.filter(~first_half).select("value").write.mode("append").text(logs)
    for _ in range(2):
        finish(to_parquet(_parsed(spark, logs), out, checkpoint))
    return log_columns(spark.read.parquet(out))
